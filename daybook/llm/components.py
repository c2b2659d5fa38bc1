"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least of itself and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them. Edges have ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link but the least of each component, which is the component's name.

    Stars are made by sums and joins on the node, so a node with a third of all links is split like any hot key. Each
    round is written to the shared folder; the driver sees a count and a checksum.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = stored(edges, "edges"), None
    for _ in range(MOST_ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        edges = stored(_small_star(stored(_large_star(edges), "edges")), "edges")
    raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
