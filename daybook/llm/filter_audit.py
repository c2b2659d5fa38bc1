"""What each of several filters removes, alone and after the others, in every order they could be applied in.

Documents become masks of the filters they fail, masks become counts per part, and the counts of a part become a
count-weighted decision diagram: one level per filter, the pass and the fail branch below each node, at every node the
documents that reach it. Two neighbouring levels are swapped in place, so a walk through all orders by neighbouring
exchanges needs one swap an order. In each order, the path on which everything passes gives the steps: the fail branch
of its node is what the filter removes there, the pass branch is what stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import stored, table
from daybook.llm.registry import query

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_UPPER_PERCENT = 5
UPPER = bytes(range(0x41, 0x5B))
MARKS = b"#$%&*|"
WEIGHTS = ("n", "good", "toxic")
STEP_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_MASK_TYPE = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

Counts = tuple[int, int, int]


# ---- diagrams


class Diagram:
    """A decision diagram over failure masks whose nodes carry how many documents reach them.

    ``order`` names the filter of each level. A node is ``(level, pass, fail)`` and is made once for each pair of
    branches; a branch that no document takes is ``None`` at any level. A leaf is a tuple of counts.
    """

    def __init__(self, filters: str, masks: dict[int, Counts]):
        self.order = list(filters)
        self._made: dict[tuple, tuple] = {}
        self._total: dict[tuple, Counts] = {}
        self.root = self._built(0, 0, masks)

    def _built(self, level: int, mask: int, masks: dict[int, Counts]):
        if level == len(self.order):
            counts = masks.get(mask)
            return counts if counts and any(counts) else None
        return self._node(level, self._built(level + 1, mask, masks), self._built(level + 1, mask | 1 << level, masks))

    def _node(self, level: int, passed, failed):
        if passed is None and failed is None:
            return None
        key = (level, passed, failed)
        node = self._made.setdefault(key, key)
        if node not in self._total:
            self._total[node] = tuple(map(sum, zip(self.total(level + 1, passed), self.total(level + 1, failed))))
        return node

    def total(self, level: int, node) -> Counts:
        """Documents that reach a node of ``level``."""
        if node is None:
            return (0,) * len(WEIGHTS)
        return node if level == len(self.order) else self._total[node]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; the nodes below both stay as they are."""
        done: dict[tuple, tuple | None] = {}

        def branches(node) -> tuple:
            return (None, None) if node is None else node[1:]

        def rebuilt(node, depth: int):
            if node is None:
                return None
            if node not in done:
                if depth < level:
                    done[node] = self._node(depth, rebuilt(node[1], depth + 1), rebuilt(node[2], depth + 1))
                else:
                    (pp, pf), (fp, ff) = branches(node[1]), branches(node[2])
                    done[node] = self._node(depth, self._node(depth + 1, pp, fp), self._node(depth + 1, pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Counts, Counts]]:
        """The filter of each level with what it leaves and what it removes, along the path on which all pass."""
        node = self.root
        for level, name in enumerate(self.order):
            passed, failed = (None, None) if node is None else node[1:]
            yield name, self.total(level + 1, passed), self.total(level + 1, failed)
            node = passed


def neighbouring_exchanges(size: int) -> Iterator[int]:
    """Levels to swap with the next one, one after the other, to see every order of ``size`` filters once."""
    if size < 2:
        return
    # the last filter travels through the others, up and down in turn; the others make one exchange at each end
    inner, down = neighbouring_exchanges(size - 1), True
    while True:
        yield from range(size - 2, -1, -1) if down else range(size - 1)
        level = next(inner, None)
        if level is None:
            return
        yield level + 1 if down else level
        down = not down


def audit_rows(masks: dict[int, Counts], filters: str = FILTERS) -> list[tuple]:
    """``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of all orders."""
    diagram = Diagram(filters, masks)
    orders = [("".join(diagram.order), list(diagram.steps()))]
    for level in neighbouring_exchanges(len(filters)):
        diagram.swap(level)
        orders.append(("".join(diagram.order), list(diagram.steps())))
    shapley, failing, alone = dict.fromkeys(filters, 0), {}, {}
    for _, steps in orders:
        for name, _, removed in steps:
            shapley[name] += removed[0]
        failing[steps[0][0]] = steps[0][2][0]  # nothing went before
        alone[steps[-1][0]] = steps[-1][2][0]  # everything else went before
    return [
        (order, place, kept[0], gone[0], failing[name] - gone[0], alone[name], gone[1], gone[2], shapley[name])
        for order, steps in sorted(orders)
        for place, (name, kept, gone) in enumerate(steps, 1)
    ]


# ---- masks


def content_mask(text: bytes, code_points: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # bytes are split at the six white-space characters of ASCII
    mask = int(len(words) < LEAST_WORDS)
    mask |= 2 * (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words))
    mask |= 4 * (100 * (len(text) - len(text.translate(None, UPPER))) > MOST_UPPER_PERCENT * code_points)
    return mask | 8 * (len(text.translate(None, MARKS)) < len(text))


def _content_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, masks = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            raw = text.encode()
            digests.append(hashlib.sha256(raw).digest())
            masks.append(content_mask(raw, len(text)))
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, schema=_MASK_TYPE)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of a part by the filters they fail, of them good and toxic ones.

    ``docs`` needs ``doc_id, text, source``; further columns don't matter. A NULL text is an empty one, a NULL source the
    part with the empty name. Filter E fails for a text that a row with a smaller id has: rows that share the smallest
    id pass, and so do rows without id, which are smaller or larger than nothing. A document is good or toxic when any
    label row of its id says so; rows without id have no labels.

    Rows with one id, text and source are counted together before anything is exchanged, so groups of copies reach
    a task as one row each. The first row of a text is found by its id and text, a pair that is no frequent key.
    """
    slim = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    masks = slim.mapInArrow(_content_masks, "doc_id long, part string, digest binary, mask int")
    rows = stored(masks.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "filter-masks")

    says = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(a) for c, a in (("quality", "is_good"), ("toxic", "is_toxic"))]
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*says)
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    told = rows.where("doc_id IS NOT NULL").join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    no, fifth = F.lit(False), 1 << FILTERS.index("E")
    with_id = told.select(
        "part",
        F.when(F.coalesce("is_first", no), F.col("mask")).otherwise(F.col("mask") + fifth).alias("mask"),
        "n",
        F.when(F.coalesce("is_good", no), F.col("n")).otherwise(0).alias("good"),
        F.when(F.coalesce("is_toxic", no), F.col("n")).otherwise(0).alias("toxic"),
    )
    nothing = F.lit(0).cast("long")
    without_id = rows.where("doc_id IS NULL").select("part", "mask", "n", nothing.alias("good"), nothing.alias("toxic"))
    return with_id.unionByName(without_id).groupBy("part", "mask").agg(*[F.sum(w).alias(w) for w in WEIGHTS])


def _audited(counts: pa.Table) -> pa.Table:
    part = counts.column("part")[0].as_py()
    masks = {r["mask"]: tuple(r[w] for w in WEIGHTS) for r in counts.to_pylist()}
    columns = zip(*[(part, *row) for row in audit_rows(masks)])
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    names = [field.split()[0] for field in STEP_SCHEMA.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step; see :func:`failure_counts` for what is counted.

    A part is at most 32 rows of counts by the time its diagram is built, however many documents it has.
    Without documents there are no parts and no rows.
    """
    return failure_counts(docs, labels).groupBy("part").applyInArrow(_audited, STEP_SCHEMA)


# ---- query


def _sql() -> str:
    """Masks, then every order as a row: a filter removes at its step what fails it and nothing before it."""
    letters = list(FILTERS)
    orders = " CROSS JOIN ".join(f"(SELECT unnest({letters}) AS f{i}) o{i}" for i in range(1, 6))
    differ = " AND ".join(f"f{i} <> f{j}" for i in range(1, 6) for j in range(i + 1, 6))
    bit = "list_position(['A','B','C','D','E'], {}) - 1"
    bits = ", ".join(f"(1 << ({bit.format(f'f{i}')}))::INT AS b{i}" for i in range(1, 6))
    before = reduce(lambda sql, i: sql + [" | ".join(f"b{j}" for j in range(1, i)) or "0"], range(1, 6), [])
    steps = " UNION ALL ".join(
        f"SELECT f1 || f2 || f3 || f4 || f5 AS filter_order, {i}::INT AS step, b{i} AS bit, ({before[i - 1]})::INT AS before FROM orders"
        for i in range(1, 6)
    )
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(words)) < {LEAST_DISTINCT_PERCENT} * len(words))::INT
         + 4 * (100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > {MOST_UPPER_PERCENT} * length(t.text))::INT
         + 8 * regexp_matches(t.text, '[#$%&*|]')::INT + 16 * coalesce(t.doc_id > first_id, false)::INT AS mask
  FROM texts t JOIN firsts USING (text) LEFT JOIN marks m ON t.doc_id = m.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
orders AS (SELECT *, {bits} FROM {orders} WHERE {differ}),
steps AS ({steps}),
told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts CROSS JOIN steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told"""


@query(_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
