"""Jaccard similarity join of word shingles, by single rare tokens and by combinations of frequent ones."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import LOWER_ASCII, WORD_BYTES, chunks, giving_back, gram_hash, mixed, ragged_ranges, stored, table, text_bytes, words
from daybook.llm.components import components
from daybook.llm.registry import query
from daybook.session import broadcast_if_small

FREQUENT = 8
MOST_FREQUENT = 1 << 20
SUMMARY = 1 << 17
ALL_PAIRS = 100
COMBINED_PAIRS = 16
HUB_OTHERS = 512
HUB_ROUNDS = 3
SKETCH = 256
CELLS = 16
_U64 = np.uint64
_SUMS = "doc_id long, n long, s1 long, s2 long, sketch binary, token long, seen long"
_CANDIDATE = "a long, b long, star boolean"


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted; a text of fewer words is one shingle."""
    data, offsets = text_bytes(column)
    text = words(LOWER_ASCII[data], offsets, WORD_BYTES)
    counts = text.counts
    rows, tokens = [], []
    if len(text.hash) >= size:
        inside = text.row[: len(text.hash) - size + 1] == text.row[size - 1 :]
        rows.append(text.row[: len(inside)][inside])
        tokens.append(gram_hash(text.hash, size)[inside])
    for short in range(1, size):
        found = np.flatnonzero(counts == short)
        if len(found):
            rows.append(found)
            tokens.append(gram_hash(text.hash, short)[text.first[found]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, _U64)
    row, token = np.concatenate(rows), np.concatenate(tokens)
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    return row[new], token[new]


class _Summary:
    """Counts of the tokens of a task: all while they fit into bounded memory, then the most frequent ones."""

    def __init__(self) -> None:
        self.token, self.seen = np.zeros(0, _U64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self.full = False

    def add(self, tokens: np.ndarray) -> None:
        self.waiting.append(tokens)
        self.size += len(tokens)
        if self.size > 1 << 20:
            self.merge()

    def merge(self) -> None:
        token, seen = np.unique(np.concatenate([np.zeros(0, _U64), *self.waiting]), return_counts=True)
        token, seen = np.append(self.token, token), np.append(self.seen, seen)
        order = np.argsort(token, kind="stable")
        token, seen = token[order], seen[order]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        token, seen = token[starts], np.add.reduceat(seen, starts) if len(starts) else seen
        if len(token) > SUMMARY:
            self.full = True
            most = np.sort(np.argpartition(-seen, SUMMARY)[:SUMMARY])
            token, seen = token[most], seen[most]
        self.token, self.seen, self.waiting, self.size = token, seen, [], 0


def _sums(size: int) -> Callable:
    """Per row the size of the set, a checksum of 128 bits and a sketch; per task the frequent tokens.

    The sketch counts the tokens of each of ``SKETCH`` classes, up to 255: the sum of the absolute differences of two
    sketches is never more than the size of the symmetric difference of the sets.
    """

    @giving_back
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "s1", "s2", "sketch", "token", "seen"]
        summary = _Summary()
        for batch in batches:
            for part in chunks(batch, "text"):
                row, token = shingles(part.column("text"), size)
                n = part.num_rows
                summary.add(token)
                first = np.searchsorted(row, np.arange(n + 1))
                sums = []
                for salt in (1, 2):
                    line = np.zeros(len(token) + 1, _U64)
                    np.cumsum(mixed(token + _U64(salt)), out=line[1:])
                    sums.append(pa.array((line[first[1:]] - line[first[:-1]]).view(np.int64)))
                nothing = pa.nulls(n, pa.int64())
                classes = np.bincount(row * SKETCH + (token >> _U64(8)).astype(np.int64) % SKETCH, minlength=n * SKETCH)
                sketch = np.minimum(classes, 255).astype(np.uint8).reshape(n, SKETCH)
                sketches = pa.array([line.tobytes() for line in sketch], pa.binary())
                sizes = pa.array(np.diff(first))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, *sums, sketches, nothing, nothing], names)
        summary.merge()
        for begin in range(0, len(summary.token), 10_000):
            token, seen = summary.token[begin : begin + 10_000], summary.seen[begin : begin + 10_000]
            often = seen > 1 if summary.full else seen > 0
            columns = [pa.nulls(int(often.sum()), pa.int64())] * 4
            columns.append(pa.nulls(int(often.sum()), pa.binary()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(token[often].view(np.int64)), pa.array(seen[often])], names)

    return scan


def _steps(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes in geometric steps: sets that link are in one step or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / _step_width(percent)).astype(np.int64)


def _step_width(percent: int) -> float:
    return 1.001 * max(np.log(100 / percent), 1e-3)


def _combinations(token: np.ndarray, n: int, step: int, percent: int) -> np.ndarray:
    """Keys of a set for one step of size: the combination of its tokens in each class of tokens.

    There are more classes than two linked sets of this step can have different tokens, so the tokens of some class are
    the same in both. A class without a token is a key only where so many are empty that nothing else need be the same.
    """
    largest = int(np.exp((step + 1) * _step_width(percent)))
    classes = int(np.ceil(1.15 * ((100 - percent) * 2 * largest // (100 + percent) + 1)))
    owner = (token % _U64(classes)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    sums = np.zeros(len(token) + 1, _U64)
    np.cumsum(mixed(token[order] + _U64(3)), out=sums[1:])
    first = np.searchsorted(owner[order], np.arange(classes + 1))
    total = sums[first[1:]] - sums[first[:-1]]
    keys = mixed(total ^ mixed(np.arange(classes, dtype=_U64) + _U64(step << 32)))
    filled = first[1:] > first[:-1]
    most_different = int((100 - percent) * (n + n * 100 / percent) / (100 + percent))
    return keys if (~filled).sum() >= classes - most_different else keys[filled]


def _keys(shared: object, size: int, percent: int) -> Callable:
    """Index keys of each set, in lists: ``rare`` has single tokens, ``often`` combinations of tokens.

    Tokens are in one order everywhere: those outside the list of frequent ones first, then by count. Two sets that link
    share their first common token among the first ``n - need + 1`` tokens of both. If it is not frequent, it is a key
    of both. If it is, so are all common tokens, both sets have fewer than ``n - need + 1`` other tokens, and such sets
    have combinations of several tokens as keys (see :func:`_combinations`), since single frequent tokens say little.
    """

    @giving_back
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                row, token = shingles(part.column("text"), size)
                rows = part.num_rows
                rank = np.zeros(len(token), np.int64)
                if len(known) and len(token):
                    at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                    rank = np.where(known[at] == token, count[at], 0)
                order = np.lexsort((token, rank, row))
                token, rank = token[order], rank[order]
                first = np.searchsorted(row, np.arange(rows + 1))
                n = np.diff(first)
                need = -(-percent * n // 100)
                place = np.arange(len(token)) - first[row]
                single = (place < (n - need + 1)[row]) & (rank == 0)
                rare = np.bincount(row[rank == 0], minlength=rows)
                steps = _steps(n, percent)
                often_row, often = [np.zeros(0, np.int64)], [np.zeros(0, _U64)]
                for one in np.flatnonzero((n > 1) & (rare < n - need + 1)).tolist():
                    mine = token[first[one] : first[one + 1]]
                    for step in (int(steps[one]), int(steps[one]) + 1):
                        often.append(_combinations(mine, int(n[one]), step, percent))
                        often_row.append(np.full(len(often[-1]), one))
                lists = []
                for owner, key in (
                    (row[single], token[single]),
                    (row[single], place[single].astype(np.int64)),
                    (np.concatenate(often_row), np.concatenate(often)),
                ):
                    offsets = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "rare", "places", "often"])

    return scan


def _bucket_candidates(percent: int, all_pairs: int) -> Callable:
    """Candidates from rows sorted by key: all pairs of a small bucket, the pairs with the least node of a larger one.

    A pair must be near enough in size, and what is left of both sets behind the common token must suffice.
    """

    def pairs_of(key: np.ndarray, node: np.ndarray, n: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        bucket_end = np.repeat(starts + sizes, sizes)
        small = np.repeat(sizes <= all_pairs, sizes)
        here = np.arange(len(key))
        partners = np.where(small, bucket_end - here - 1, 0)
        left = np.repeat(here, partners)
        right = ragged_ranges(here + 1, partners)
        n_a, n_b = n[left], n[right]
        need = -(-percent * (n_a + n_b) // (100 + percent))
        ahead = np.minimum(n_a - place[left], n_b - place[right])
        good = (node[left] != node[right]) & (ahead >= need)
        # rows of a bucket are in the order of the node, so its first row is its least node
        hub = np.repeat(starts, sizes)
        spoke = ~small & (node[hub] != node)
        a = np.concatenate([node[left[good]], node[hub[spoke]]])
        b = np.concatenate([node[right[good]], node[spoke]])
        star = np.concatenate([np.zeros(int(good.sum()), bool), np.ones(int(spoke.sum()), bool)])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(star)], ["a", "b", "star"])

    @giving_back
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            packed = batch.column("packed").to_numpy()
            fresh = [batch.column("key").to_numpy(), batch.column("node").to_numpy(), packed >> 32, packed & 0xFFFFFFFF]
            held = [np.concatenate(x) for x in zip(held, fresh, strict=True)]
            if not len(held[0]):
                continue
            end = int(np.searchsorted(held[0], held[0][-1]))
            for begin, stop in _bounded(held[0][:end]):
                yield pairs_of(*(x[begin:stop] for x in held))
            held = [x[end:] for x in held]
        if len(held[0]):
            yield pairs_of(*held)

    return scan


def _bounded(key: np.ndarray, rows: int = 20_000) -> Iterator[tuple[int, int]]:
    """Ranges of whole keys of about ``rows`` rows."""
    begin = 0
    while begin < len(key):
        stop = min(begin + rows, len(key))
        stop = len(key) if stop == len(key) else int(np.searchsorted(key, key[stop - 1], "right"))
        yield begin, stop
        begin = stop


def _compare(size: int, percent: int) -> Callable:
    """Size of the symmetric difference of two whole texts' sets, and the difference itself for pairs of a star."""

    @giving_back
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text_a", 1 << 19):
                rows = part.num_rows
                (row_a, a), (row_b, b) = shingles(part.column("text_a"), size), shingles(part.column("text_b"), size)
                n_a, n_b = np.bincount(row_a, minlength=rows), np.bincount(row_b, minlength=rows)
                row, token = np.append(row_a, row_b), np.append(a, b)
                order = np.lexsort((token, row))
                row, token = row[order], token[order]
                twin = (row[1:] == row[:-1]) & (token[1:] == token[:-1])
                once = ~(np.append(twin, False) | np.append(False, twin))
                differ = np.bincount(row[once], minlength=rows)
                linked = (100 - percent) * (n_a + n_b) >= (100 + percent) * differ
                star = part.column("star").to_numpy(zero_copy_only=False)
                listed = once & star[row]
                offsets = np.searchsorted(row[listed], np.arange(rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token[listed].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), part.column("star"), pa.array(linked), pa.array(n_b), lists],
                    ["a", "b", "star", "linked", "n_b", "differ"],
                )

    return scan


def _near_sketches(percent: int) -> Callable:
    """Candidates whose sketches don't rule out a link; pairs of a star stay, since they place their members."""

    @giving_back
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int16)
                for name in ("sketch_a", "sketch_b")
            )
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            near = (100 + percent) * np.abs(a - b).sum(axis=1) <= (100 - percent) * both
            keep = pa.array(near | batch.column("star").to_numpy(zero_copy_only=False))
            yield batch.select(["a", "b", "star"]).filter(keep)

    return scan


def _sketched(candidates: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        one = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        candidates = candidates.join(one, side)
    columns = candidates.select("a", "b", "star", "n_a", "n_b", "sketch_a", "sketch_b")
    return columns.mapInArrow(_near_sketches(percent), _CANDIDATE)


def _verified(candidates: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Compare candidates in full. ``texts`` has ``node, text`` for each node."""
    nodes = candidates.select(F.col("a").alias("node")).union(candidates.select(F.col("b").alias("node"))).distinct()
    (chosen,) = broadcast_if_small(stored(nodes, "near-nodes"))
    used = stored(texts.join(chosen, "node", "left_semi"), "near-texts")
    first = candidates.join(used.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(used.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    schema = "a long, b long, star boolean, linked boolean, n_b long, differ array<long>"
    return stored(both.select("a", "b", "star", "text_a", "text_b").mapInArrow(_compare(size, percent), schema), "compared")


def _hub_tokens(member: DataFrame) -> DataFrame:
    """The differences of members to their hubs, a row per token and its ``place`` in the list, rare tokens first.

    Tokens that one member alone differs in are counted in the places, but not returned.
    """
    kept = [name for name in member.columns if name != "differ"]
    spread = member.select(*kept, F.size("differ").alias("d"), F.explode("differ").alias("token"))
    seen = spread.groupBy("hub", "token").agg(F.count("*").alias("seen"))
    ordered = Window.partitionBy("hub", "node").orderBy("seen", "token")
    placed = spread.join(seen, ["hub", "token"]).withColumn("place", F.row_number().over(ordered))
    return placed.where("seen > 1").drop("seen")


def _sides(x: DataFrame, y: DataFrame) -> DataFrame:
    keys = ["hub", "token"]
    left = x.select(*keys, *[F.col(c).alias(f"x_{c}") for c in x.columns if c not in keys])
    return left.join(y.select(*keys, *[F.col(c).alias(f"y_{c}") for c in y.columns if c not in keys]), keys)


def _hub_condition(percent: int) -> str:
    """What a pair of members must fulfil to link, unless both are so near the hub that they link in any case.

    The difference of two sets is the difference of their differences to the hub. Two sets that link therefore share a
    known number of these tokens, so the prefixes of these short lists have one in common.
    """
    most = f"floor({100 - percent} * (x_n + y_n) / {100 + percent})"
    share = f"ceil((x_d + y_d - {most}) / 2)"
    return (
        f"abs(x_d - y_d) <= {most} AND {share} >= 1"
        f" AND x_place <= x_d - {share} + 1 AND y_place <= y_d - {share} + 1"
    )


def _all_around_hubs(stars: DataFrame, percent: int) -> DataFrame:
    """Candidates for every link among the members of a star but those of :func:`_close_to_hubs`."""
    placed = stored(_hub_tokens(stars.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("n_b").alias("n"), "differ")), "hub-tokens")
    pairs = _sides(placed, placed).where(f"x_node < y_node AND {_hub_condition(percent)}")
    return pairs.select(F.col("x_node").alias("a"), F.col("y_node").alias("b"), F.lit(False).alias("star")).distinct()


def _mixed_buckets(stars: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Members of a star that share a token of their differences to the hub, where links could join two components.

    A bucket (``hub, token``) of one component needs no pairs. The others have ``main``, their most frequent component,
    ``others``, the number of members outside it, and ``again``, one of these as a hub for the bucket.
    """
    member = stars.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("n_b").alias("n"), "differ")
    member = member.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = stored(member, "hub-members")
    several = member.groupBy("hub").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    (several,) = broadcast_if_small(stored(several.where("least < most").select("hub"), "hubs"))
    placed = _hub_tokens(member.join(several, "hub"))
    # no partner can have a longer prefix with this member than with the largest set that links with it
    placed = stored(placed.where(f"place <= floor({100 - percent} * n / {percent}) + 1"), "hub-tokens")
    parts = placed.groupBy("hub", "token", "component").agg(F.count("*").alias("members"), F.min("node").alias("node"))
    named = F.struct("component", "node")
    buckets = parts.groupBy("hub", "token").agg(
        F.sum("members").alias("members"),
        F.max(F.struct("members", "component")).alias("most"),
        F.min(named).alias("low"),
        F.max(named).alias("high"),
    )
    main = F.col("most.component")
    buckets = buckets.where("low.component < high.component").select(
        "hub",
        "token",
        main.alias("main"),
        (F.col("members") - F.col("most.members")).alias("others"),
        F.when(main == F.col("low.component"), F.col("high.node")).otherwise(F.col("low.node")).alias("again"),
    )
    (buckets,) = broadcast_if_small(stored(buckets, "hub-buckets"))
    return stored(placed.join(buckets, ["hub", "token"]), "bucket-members")


def _between_components(buckets: DataFrame, percent: int, most_others: int | None) -> DataFrame:
    """Candidates from :func:`_mixed_buckets` that could join two components.

    The ``others`` of a bucket are paired with its members if there are at most ``most_others`` (None: in any case), so
    a member is in a bounded number of pairs. Larger buckets give the pairs with the hub ``again``.
    """
    listed = buckets if most_others is None else buckets.where(F.col("others") <= most_others)
    member = listed.select("hub", "token", "node", "n", "d", "place", "component", "main")
    (other,) = broadcast_if_small(stored(member.where("component <> main"), "bucket-others"))
    pairs = _sides(other.drop("main"), member).where(
        f"x_component <> y_component AND (y_component = y_main OR x_node < y_node) AND {_hub_condition(percent)}"
    )
    pairs = pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"), F.lit(False).alias("star"))
    if most_others is not None:
        spokes = buckets.where((F.col("others") > most_others) & (F.col("node") != F.col("again")))
        pairs = pairs.union(spokes.select(F.col("again").alias("a"), F.col("node").alias("b"), F.lit(True).alias("star")))
    return pairs.groupBy("a", "b").agg(F.max("star").alias("star"))


def _close_to_hubs(stars: DataFrame, percent: int) -> DataFrame:
    """Links among the members of a star that are so near its hub that their differences to it can't add up to too much.

    The pairs of one star are dealt to ``CELLS`` times ``CELLS`` keys.
    """
    member = stars.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("n_b").alias("n"), F.size("differ").alias("d"))
    member = stored(member.withColumn("cell", F.pmod(F.xxhash64("node"), F.lit(CELLS))), "hub-members")
    cells = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CELLS - 1).cast("long")))
    x, y = (member.select("hub", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "d", "cell")]) for side in "xy")
    x, y = x.withColumn("y_cell", cells), y.withColumn("x_cell", cells)
    near = f"x_node < y_node AND {100 + percent} * (x_d + y_d) <= {100 - percent} * (x_n + y_n)"
    pairs = x.join(y, ["hub", "x_cell", "y_cell"]).where(near)
    return pairs.select(F.col("x_node").alias("a"), F.col("y_node").alias("b"))


def _gathered_stars(stars: DataFrame, found: DataFrame, compare: Callable) -> tuple[DataFrame, DataFrame]:
    """``stars`` with those of several components moved to a larger star that their hub is a member of; the pairs compared for it.

    The least members of the many buckets of a family make many stars of nearly the same members. Differences to any
    one hub tell which members link, so members that a larger star has, too, need no list around the smaller one's
    hub; the others are compared with the larger one's hub. A star is moved if that makes fewer tokens, where a
    difference to the new hub counts as the differences on the way to it. Hubs are the least nodes of their stars.
    """
    member = stars.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.size("differ").alias("d")).join(found, "node", "left")
    member = stored(member.withColumn("component", F.coalesce("component", "node")), "star-members")
    sizes = member.groupBy("hub").agg(F.count("*").alias("size"), F.min("component").alias("least"), F.max("component").alias("most"))
    sizes = stored(sizes, "star-sizes")
    inner = sizes.where("least < most").select(F.col("hub").alias("node")).join(member, "node").join(sizes.select("hub", "size"), "hub")
    larger = F.max(F.struct("size", -F.col("hub"), F.col("hub").alias("to_hub"), F.col("d").alias("way"))).alias("best")
    ways = inner.groupBy("node").agg(larger).select(F.col("node").alias("hub"), "best.to_hub", "best.way")
    there = member.select(F.col("hub").alias("to_hub"), "node", F.lit(True).alias("is_there")).distinct()
    trial = member.join(ways, "hub").join(there, ["to_hub", "node"], "left").withColumn("fresh", F.col("is_there").isNull())
    trial = stored(trial.select("hub", "to_hub", "node", "d", "way", "fresh"), "star-moves")
    cost = trial.groupBy("hub", "to_hub").agg(F.sum("d").alias("now"), F.sum(F.when(F.col("fresh"), F.col("d") + F.col("way"))).alias("then"))
    better = cost.where("coalesce(then, 0) < now").select("hub", "to_hub")
    moved = better.join(better.select(F.col("hub").alias("to_hub")), "to_hub", "left_anti").select("hub")
    (moved,) = broadcast_if_small(stored(moved, "moved-stars"))
    fresh = trial.where("fresh AND node <> to_hub").join(moved, "hub", "left_semi")
    compared = compare(fresh.select(F.col("to_hub").alias("a"), F.col("node").alias("b"), F.lit(True).alias("star")).distinct())
    kept = stars.join(moved.select(F.col("hub").alias("a")), "a", "left_anti").select(stars.columns)
    return kept.union(compared.select(stars.columns)), compared


def _joined_components(stars: DataFrame, done: DataFrame, found: DataFrame, compare: Callable, percent: int) -> DataFrame:
    """``found`` with the components joined that links among the members of a star join.

    Each round pairs the few members of a bucket outside its main component with all its members. Where these are more
    than ``HUB_OTHERS``, one of them becomes a hub of its own and the next round goes on with the differences to it, which
    lack the token that all members of the bucket share. Families whose members link end after a round; at the edge of
    linking a family can have many components, each round adds stars for them, and more rounds cost more than pairs.
    The round ``HUB_ROUNDS`` lists what is left in full, so no link is lost.
    """
    stars, moved = _gathered_stars(stars, found, compare)
    done, fresh_links = done.union(moved.select("a", "b")), moved.where("linked").select("a", "b")
    if not fresh_links.isEmpty():
        found = components(fresh_links.union(found.select(F.col("component").alias("a"), F.col("node").alias("b"))))
    for left in reversed(range(HUB_ROUNDS)):
        buckets = _mixed_buckets(stars, found, percent)
        if buckets.isEmpty():
            break
        pairs = stored(_between_components(buckets, percent, HUB_OTHERS if left else None), "candidates")
        fresh = pairs.where("NOT star").join(done, ["a", "b"], "left_anti").union(pairs.where("star"))
        compared = compare(fresh)
        tied = compared.where("linked").select("a", "b").union(found.select(F.col("component").alias("a"), F.col("node").alias("b")))
        found = components(tied)
        stars = compared.where("star")
        done = done.union(compared.select("a", "b"))
    return found


def _link_counts(links: DataFrame, members: DataFrame) -> DataFrame:
    """``link_class, class_size, class_links``: the documents of each class, and those of all classes it links with."""
    named = members.where("n > 0 AND class_id IS NOT NULL")
    sizes = stored(named.groupBy(F.col("class_id").alias("link_class")).agg(F.count_distinct("doc_id").alias("class_size")), "class-sizes")
    both = links.select(F.col("a").alias("link_class"), F.col("b").alias("other"))
    both = both.union(both.select(F.col("other").alias("link_class"), F.col("link_class").alias("other")))
    others = sizes.select(F.col("link_class").alias("other"), F.col("class_size").alias("other_size"))
    linked = both.join(others, "other").groupBy("link_class").agg(F.sum("other_size").alias("class_links"))
    return sizes.join(linked, "link_class", "left")


def near_duplicates(
    docs: DataFrame, size: int = 4, percent: int = 85, id_column: str = "doc_id", text: str = "text", with_links: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id``, and ``n_links`` if asked for.

    The set of a text holds its distinct ``size``-word shingles, after lower-casing A-Z; a text of fewer words is one
    shingle, and NULL, empty and blank texts have none. Two texts link when their sets have a Jaccard similarity of
    ``percent`` / 100 or more. ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id that
    links reach; texts without words are alone. Rows without id take part only as copies of a row with one, their own
    class has no id otherwise. Rows that repeat an id with different texts count as one document. ``n_links`` is the
    number of other documents that the text links with, copies included. All links are found for it, as many as a family
    of different texts has pairs; components alone need fewer.

    Equal sets are joined first, so copies cost one row each. Then candidates share a token of the prefixes of
    their sets or, where tokens are frequent, a combination of tokens, and every candidate that a sketch
    of its sets does not rule out is compared in full. Buckets are small or
    give the pairs with one hub each, and so do large buckets of the members of a hub (see :func:`_joined_components`),
    so no bucket lists its square; stars of one family are gathered around few hubs (:func:`_gathered_stars`). The list of frequent
    tokens has a bounded length, and results do not depend on what is in it.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sums = stored(plain.mapInArrow(_sums(size), _SUMS), "shingle-sums")
    sets = sums.where("n IS NOT NULL").select("doc_id", "n", "s1", "s2")
    sketches = sums.where("n > 0 AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("node"), "n")
    sketches = sketches.agg(F.min("sketch").alias("sketch"))
    classes = sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id"))
    classes = stored(classes, "shingle-classes")
    summed = sums.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).where(f"seen >= {FREQUENT}")
    listed = summed.orderBy(F.desc("seen"), "token").limit(MOST_FREQUENT).toArrow()
    known, count = listed["token"].to_numpy().view(_U64), listed["seen"].to_numpy()
    order = np.argsort(known)
    shared = spark.sparkContext.broadcast((known[order], count[order]))
    lists = plain.where("doc_id IS NOT NULL").mapInArrow(
        _keys(shared, size, percent), "doc_id long, rare array<long>, places array<long>, often array<long>"
    )
    nodes = classes.where("n > 1 AND class_id IS NOT NULL").groupBy(F.col("class_id").alias("doc_id")).agg(F.max("n").alias("n"))
    keyed = stored(lists.join(nodes, "doc_id").withColumnRenamed("doc_id", "node"), "prefix-keys")
    zipped = F.posexplode("rare").alias("at", "key")
    packed = F.shiftleft(F.col("n"), 32).bitwiseOR(F.col("places")[F.col("at")])
    rare = keyed.select("node", "n", "places", zipped).select("key", "node", packed.alias("packed"))
    buckets = rare.repartition("key").sortWithinPartitions("key", "node")
    from_rare = buckets.mapInArrow(_bucket_candidates(percent, ALL_PAIRS), _CANDIDATE)
    often = keyed.select("node", F.explode("often").alias("key"))
    hubs = often.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("seen"))
    shared_keys = stored(often.join(hubs.where("hub < last"), "key").select("key", "node", "hub", "seen"), "shared-keys")
    few = shared_keys.where(f"seen <= {COMBINED_PAIRS}")
    partner = few.select("key", F.col("node").alias("b"))
    in_few = few.select("key", F.col("node").alias("a")).join(partner, "key").where("a < b").select("a", "b", F.lit(False).alias("star"))
    spokes = shared_keys.where(f"seen > {COMBINED_PAIRS} AND node <> hub")
    from_often = in_few.union(spokes.select(F.col("hub").alias("a"), F.col("node").alias("b"), F.lit(True).alias("star")))
    candidates = _sketched(from_rare.union(from_often).groupBy("a", "b").agg(F.max("star").alias("star")), sketches, percent)
    texts = plain.select(F.col("doc_id").alias("node"), "text")
    compared = _verified(stored(candidates, "candidates"), texts, size, percent)
    stars = compared.where("star")
    links = compared.where("linked").select("a", "b")

    def compare(pairs: DataFrame) -> DataFrame:
        return _verified(_sketched(pairs, sketches, percent), texts, size, percent)

    if with_links:
        around = stored(_all_around_hubs(stars, percent), "candidates")
        again = compare(around.join(compared.select("a", "b"), ["a", "b"], "left_anti"))
        links = links.union(again.where("linked").select("a", "b"))
    found = components(links)
    if not with_links:
        found = _joined_components(stars, compared.select("a", "b"), found, compare, percent)
    found = found.withColumnRenamed("node", "class_id")
    members = sets.join(classes, ["n", "s1", "s2"], "left").join(found, "class_id", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class_id"))
    counts = []
    if with_links:
        every = stored(links.union(_close_to_hubs(stars, percent)).distinct(), "links")
        sums = _link_counts(every, members.select("doc_id", "n", "class_id"))
        members = members.join(sums, F.col("class_id") == F.col("link_class"), "left")
        copies = F.col("class_size") - F.col("doc_id").isNotNull().cast("long")
        total = F.when(F.col("n") > 0, copies + F.coalesce("class_links", F.lit(0)))
        counts.append(F.coalesce(total, F.lit(0)).alias("n_links"))
    return members.select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("class_id"), F.coalesce("component", own).alias("component_id"), *counts
    )


@query(r"""
WITH RECURSIVE
lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM lowered WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingles x JOIN shingles y USING (shingle)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 85 * (p.n + q.n - o)),
reached AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.r)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
