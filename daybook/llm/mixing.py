"""Mixing sources to target weights with exact block quotas."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import BLANK, stored, table
from daybook.llm.registry import query
from daybook.session import broadcast_if_small

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3.0
BLOCK_BITS = 10
LEVELS = 3
MOST_SOURCES = 100_000
SHARD_WORDS = 1 << 27
LEAST_SHARDS = 64
SHARD_BLOCKS = 16
MOST_BITS = 30
_SIGN = -(1 << 63)
_FACTS = (
    "mix_number int, mix_source string, mix_source_size long, mix_target double, mix_epochs int, mix_cut long, mix_bits int"
)
_RUNS = "mix_number int, shards array<int>, ends array<long>"

_SHUFFLED = ("mix_shard", "mix_order", "mix_size")


def _block(level: int) -> F.Column:
    """The block of a row at a level: the leading bits of its place in the permutation, as an unsigned number."""
    return F.shiftrightunsigned(F.col("place"), 64 - BLOCK_BITS * (level + 1))


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> dict[str | None, float]:
    """Words that each source should give; together they are all words, and none is above ``most`` times its source.

    Sources in order of code points, NULL last, have the weights in turn. What a source can't give goes to the others by
    weight until none is above its bound.
    """
    names = sorted((name for name in sizes if name is not None), key=lambda name: [ord(c) for c in name])
    names += [None] if None in sizes else []
    weight = {name: weights[place % len(weights)] for place, name in enumerate(names)}
    left, free, result = float(sum(sizes.values())), list(names), {}
    while free:
        unit = left / sum(weight[name] for name in free)
        over = [name for name in free if weight[name] * unit > most * sizes[name]]
        if not over:
            return result | {name: weight[name] * unit for name in free}
        for name in over:
            result[name] = most * sizes[name]
            left -= result[name]
            free.remove(name)
    return result


def _quota_tree(blocks: list[int], shards: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard in order the sources that give it blocks and how many: see :func:`shard_quotas`.

    A node knows only the sources that have blocks in it, so the whole tree takes work in proportion to all blocks.
    """

    def split(sources: np.ndarray, counts: np.ndarray, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if high - low == 1:
            yield low, sources, counts
            return
        middle = (low + high) // 2
        take = int(counts.sum()) * (middle - low) // (high - low)
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(counts, take, method="marginals") if take else np.zeros_like(counts)
        for part, start, end in ((left, low, middle), (counts - left, middle, high)):
            yield from split(sources[part > 0], part[part > 0], start, end)

    counts = np.array(blocks, np.int64)
    yield from split(np.flatnonzero(counts), counts[counts > 0], 0, shards)


def shard_quotas(blocks: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard: shards get equal numbers of blocks, as if all blocks had been shuffled.

    A tree halves the shards; at each node the blocks of the left half are one multivariate hypergeometric draw from the
    blocks of the node, so all block counts are exact.
    """
    quotas = np.zeros((len(blocks), shards), np.int64)
    for shard, sources, counts in _quota_tree(blocks, shards, seed):
        quotas[sources, shard] = counts
    return quotas


def shards_of(words: int) -> int:
    """Shards for a mix of so many words: of ``SHARD_WORDS`` words each, and at least ``LEAST_SHARDS``."""
    return max(LEAST_SHARDS, -(-words // SHARD_WORDS))


def block_bits(words: int, all_words: int, shards: int) -> int:
    """Bits that number the blocks of a source: blocks of all sources have about ``1 / SHARD_BLOCKS`` of a shard's words."""
    wanted = SHARD_BLOCKS * shards * words / all_words if all_words else 1
    return min(MOST_BITS, max(1, math.ceil(math.log2(max(wanted, 1)))))


def _partial_cut(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source the place up to which its rows together have nearly ``need`` words: ``source, mix_cut``.

    Level by level the block in which the need ends is found from sums per block, then rows of the last block are added
    one by one. Each window holds the blocks of one block at most, or the rows of one smallest block.
    """
    by_block = Window.partitionBy("source").orderBy("block")

    def rows_of(state: DataFrame) -> DataFrame:
        return sized.join(F.broadcast(state.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    state = wanted.select("source", "need", F.lit(None).cast("long").alias("parent"))
    for level in range(LEVELS):
        rows = rows_of(state)
        if level:
            rows = rows.where(_block(level - 1) == F.col("parent"))
        sums = rows.groupBy("source", "need", _block(level).alias("block")).agg(F.sum("size").alias("words"))
        run = sums.withColumn("through", F.sum("words").over(by_block))
        holds = run.where("through > need AND through - words <= need")
        rest = F.col("need") - (F.col("through") - F.col("words"))
        state = holds.select("source", rest.alias("need"), F.col("block").alias("parent"))
    last = rows_of(state).where(_block(LEVELS - 1) == F.col("parent"))
    rows = last.groupBy("source", "need", "parent", "place").agg(F.sum("size").alias("words"))
    run = rows.withColumn("through", F.sum("words").over(Window.partitionBy("source").orderBy("place")))
    near = F.max(F.when(F.expr("through - words / 2 <= need"), F.col("place")))
    low_bits = 64 - BLOCK_BITS * LEVELS
    start = F.shiftleft(F.col("parent") - 1, low_bits).bitwiseOR(F.lit((1 << low_bits) - 1))
    cut = F.coalesce(near, F.when(F.col("parent") > 0, start)).alias("mix_cut")
    return run.groupBy("source", "parent").agg(cut).drop("parent")


def mix_plan(docs: DataFrame, **options: object) -> DataFrame:
    """How often each row goes into the mix.

    Returns the documents with ``mix_place`` (the row's place in the seeded permutation of its source), ``mix_size``
    (words of the text, NULL text 0), ``mix_source_size``, ``mix_target``, ``mix_copies`` and ``mix_bits`` (how many
    leading bits of the place number its block). The last epoch of a source is a part of it: whole blocks in permuted
    order and the leading rows of one more block, so that the words come within half a row of the target. Rows that agree
    in id and text have one place and are taken together; rows without an id, or that share one, have places of their own
    as long as their texts differ. Options are those of :func:`planned_mix`.

    An empty table gives no rows. NULL is a source of its own. Columns of the documents whose names begin with ``mix_`` are
    replaced. Only one row per source reaches the driver, and a table with more than ``MOST_SOURCES`` sources is refused.
    """
    return planned_mix(docs, **options)[0]


def planned_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_EPOCHS,
    shards: int | None = None,
    seed: int = 8,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame, int]:
    """The rows of :func:`mix_plan`, the shard of each block (``mix_number, mix_block, mix_shard``) and the number of shards.

    Unless given, the number of shards follows from all words (:func:`shards_of`), and that of blocks of a source from
    its words and the shards. There are ``SHARD_BLOCKS`` blocks to a shard and epoch, up to twice that by rounding.
    """
    spark = docs.sparkSession
    docs = docs.select(*[name for name in docs.columns if not name.startswith("mix_")])
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^{BLANK}]+")).cast("long")
    place = F.xxhash64(F.col(id_column), F.coalesce(F.col(text), F.lit("")), F.lit(seed))
    marked = docs.withColumns({"mix_place": place, "mix_size": size})
    sized = stored(
        marked.select(F.col(source).cast("string").alias("source"), F.col("mix_place").alias("place"), F.col("mix_size").alias("size")),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    words = {row.source: row.words for row in sorted(totals, key=lambda row: (row.source is None, row.source or ""))}
    all_words = sum(words.values())
    shards = shards_of(all_words) if shards is None else shards
    target = targets(words, weights, most)
    epochs = {name: int(target[name] // words[name]) if words[name] else 0 for name in words}
    need = [(name, float(target[name] - epochs[name] * words[name])) for name in words if words[name]]
    need = [(name, words_left) for name, words_left in need if words_left > 0]
    cuts = _partial_cut(sized, spark.createDataFrame(need, "source string, need double")).collect()
    cut = {row.source: row.mix_cut for row in cuts}
    facts, blocks = [], []
    for number, name in enumerate(words):
        bits = block_bits(words[name], all_words, shards)
        last = -1 if cut.get(name) is None else (cut[name] % (1 << 64)) >> (64 - bits)
        facts.append((number, name, words[name], target[name], epochs[name], cut.get(name), bits))
        blocks.append((epochs[name] << bits) + last + 1)
    runs = [(number, [], []) for number in range(len(blocks))]
    for shard, sources, counts in _quota_tree(blocks, shards, seed):
        for number, count in zip(sources.tolist(), counts.tolist(), strict=True):
            ends = runs[number][2]
            runs[number][1].append(shard)
            ends.append((ends[-1] if ends else 0) + count)
    per_source = spark.createDataFrame(facts, _FACTS)
    joined = marked.join(F.broadcast(per_source), F.col(source).cast("string").eqNullSafe(F.col("mix_source")), "left")
    flip = F.lit(_SIGN)
    part = F.coalesce((F.col("mix_place").bitwiseXOR(flip) <= F.col("mix_cut").bitwiseXOR(flip)).cast("int"), F.lit(0))
    planned = joined.withColumn("mix_copies", F.coalesce(F.col("mix_epochs"), F.lit(0)) + part)
    starts = spark.createDataFrame(runs, _RUNS).select("mix_number", "ends", F.posexplode("shards").alias("at", "mix_shard"))
    starts = starts.selectExpr("mix_number", "mix_shard", "if(at = 0, 0L, ends[at - 1]) AS low", "ends[at] AS high")
    dealt = starts.selectExpr("mix_number", "explode(sequence(low, high - 1)) AS mix_block", "mix_shard")
    return planned, dealt, shards


def drawn(planned: DataFrame, dealt: DataFrame, columns: list[str], shards: int) -> DataFrame:
    """The copies of planned rows: ``columns`` and those of :func:`mix`, dealt to shards and shuffled inside them.

    The table of blocks is broadcast when it is measured to be small; otherwise rows and blocks are joined by a shuffle,
    in which a key is one block.
    """
    copies = planned.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.expr("sequence(0, mix_copies - 1)")))
    block = F.expr("shiftleft(CAST(mix_copy AS BIGINT), mix_bits) + shiftrightunsigned(mix_place, 64 - mix_bits)")
    order = F.xxhash64("mix_place", "mix_copy", F.lit(1))
    marked = copies.withColumns({"mix_block": block, "mix_order": order})
    kept = [name for name in columns if not name.startswith("mix_")]
    (blocks,) = broadcast_if_small(dealt)
    found = marked.join(blocks, ["mix_number", "mix_block"]).select(
        *kept, "mix_place", "mix_size", "mix_source", "mix_copy", "mix_block", "mix_shard", "mix_order"
    )
    return found.repartitionById(shards, F.col("mix_shard")).sortWithinPartitions(*_SHUFFLED)


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mix: each row as often as the plan takes it, in the order of shards, each of which is one partition.

    Blocks are drawn by the quotas of :func:`shard_quotas`: ``mix_block`` counts the blocks of a source, epoch after
    epoch, and a block goes to one shard (``mix_shard``) as a whole. Inside a shard the rows of all its blocks are
    shuffled, by ``mix_order``. Further columns are ``mix_copy`` (the epoch), ``mix_place``, ``mix_source`` and ``mix_size``.
    """
    planned, dealt, shards = planned_mix(docs, **options)
    return drawn(planned, dealt, docs.columns, shards)


@query()
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words that are taken of it and where its copies are: ``draws`` has shard and position of each.

    Rows that agree in id, source and text are taken together, and name the draws of all of them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    planned, dealt, shards = planned_mix(docs)
    same = ["doc_id", "mix_source", "mix_place", "mix_size"]
    position = F.row_number().over(Window.partitionBy("mix_shard").orderBy(*_SHUFFLED[1:]))
    placed = drawn(planned, dealt, docs.columns, shards).withColumn("position", position - 1)
    found = placed.groupBy(*[F.col(name).alias(f"of_{name}") for name in same]).agg(
        F.sum("mix_size").alias("words"),
        F.count_if(F.col("mix_copy") == 0).alias("rows"),
        F.sort_array(F.collect_list(F.struct(F.col("mix_shard").alias("shard"), "position"))).alias("draws"),
    )
    of_row = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in same]
    return planned.join(found, of_row, "left").select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.coalesce(F.expr("words div rows"), F.lit(0)).alias("taken"),
        F.coalesce("draws", F.array().cast("array<struct<shard:int,position:int>>")).alias("draws"),
    )
