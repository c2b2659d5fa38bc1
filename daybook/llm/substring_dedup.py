"""Removal of long byte strings that an earlier document holds."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.bloom import bloom, maybe
from daybook.llm.common import U64, chunks, giving_back, kept_by, kept_in, mixed, ragged_ranges, remove, span_hash, span_sums, stored, table, text_bytes
from daybook.llm.registry import query
from daybook.session import ROW_OVERHEAD_BYTES, hinted, new_folder

LENGTH = 50
GRAM = 20
GRAM_BITS = 40
#: What a task works on and holds at a time; the arrays made of it are many times as large.
SCAN_BYTES, HELD_ANCHORS = 1 << 17, 1_000_000
#: Contexts are summed and joined in slices of their grams, one after the other, so that the disk holds the shuffles of a part.
SLICE_BYTES, MOST_SLICES = 1 << 29, 16
#: Of all bytes of text one in so many may start a listed string at a time; if there are more strings, they come in parts.
LISTED_SHARE, LISTED_STRINGS = 12, 1 << 22
#: With more repeated grams than this their filter lets many others through, and each slice has a filter of its own.
CROWDED_GRAMS = 1 << 24
#: Marks the contexts that are edges in a span.
_EDGE = 1 << 31
#: What names a row: its id and, where an id has several texts, a hash of the text, else NULL.
_ROW = ("doc_id", "text_key")
_ROW_SCHEMA = "doc_id long, text_key long"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


@dataclass
class Anchors:
    """Places whose gram stands for the windows from ``low`` to ``high``; bytes ``low`` to ``high + length`` are its context."""

    row: np.ndarray
    gram: np.ndarray
    low: np.ndarray
    high: np.ndarray
    context: np.ndarray


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> Anchors:
    """For each window of ``length`` bytes inside a row the first of its least grams; neighbours with one gram are joined.

    Equal windows have their anchor at the same place, whatever lies around them.
    """
    nothing = np.zeros(0, np.int64)
    count = len(data) - length + 1
    if count <= 0:
        return Anchors(nothing, np.zeros(0, U64), nothing, nothing, np.zeros(0, U64))
    gram = min(GRAM, length)
    sums = span_sums(data)
    start = np.arange(len(data) - gram + 1)
    value = span_hash(sums, start, start + gram)
    least, at, done = value, start.astype(np.int32), 1
    while done < length - gram + 1:
        step = min(done, length - gram + 1 - done)
        # both parts overlap for the last step; the first of equal values stays
        take = least[step:] < least[:-step]
        at = np.where(take, at[step:], at[:-step])
        least = np.where(take, least[step:], least[:-step])
        done += step
    row = np.searchsorted(offsets, np.arange(count), "right") - 1
    inside = np.arange(count) + length <= offsets[row + 1]
    window = np.flatnonzero(inside)
    at, row = at[window], row[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    low, high = window[first], window[last]
    return Anchors(row[first], value[at[first]], low, high, span_hash(sums, low, high + length))


def _short(gram: np.ndarray) -> np.ndarray:
    return gram >> U64(64 - GRAM_BITS)


def _grams(length: int) -> Callable:
    """The grams of a task: once each, twice if two of its documents have it."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, seen = np.unique(np.concatenate(held), return_counts=True)
            out = np.repeat(gram, np.minimum(seen, 2)).view(np.int64)
            for begin in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(out[begin : begin + 50_000])], ["gram"])

        for batch in batches:
            for part in chunks(batch, "text", SCAN_BYTES):
                found = anchors(*text_bytes(part.column("text")), length)
                order = np.lexsort((found.gram, found.row))
                row, gram = found.row[order], _short(found.gram[order])
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
                held.append(gram[new])
                size += len(gram)
                if size > HELD_ANCHORS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return scan


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted values those that come twice."""
    last = np.zeros(0, np.int64)
    for batch in batches:
        value = np.append(last, batch.column("gram").to_numpy())
        last = value[-1:]
        found = value[1:][value[1:] == value[:-1]]
        yield pa.RecordBatch.from_arrays([pa.array(found)], ["gram"])


def _contexts(repeated: Broadcast, length: int, slices: int) -> Callable:
    """The anchors whose gram the filter has, with their contexts; those of a slice lie side by side."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", SCAN_BYTES):
                data, offsets = text_bytes(part.column("text"))
                found = anchors(data, offsets, length)
                use = np.flatnonzero(maybe(repeated, _short(found.gram)))
                use = use[np.argsort(_short(found.gram[use]) % U64(slices), kind="stable")]
                start = found.low[use] - offsets[found.row[use]]
                size = found.high[use] - found.low[use] + length
                columns = [
                    *[part.column(name).take(pa.array(found.row[use])) for name in _ROW],
                    pa.array(_short(found.gram[use]).view(np.int64)),
                    pa.array(found.context[use].view(np.int64)),
                    pa.array((start << 32) | size),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*_ROW, "gram", "context", "span"])

    return scan


def _digest(kept: np.ndarray) -> str:
    return hashlib.sha256(kept.tobytes()).hexdigest()


def _pack(spans: np.ndarray) -> bytes:
    return spans.astype("<i4").tobytes()


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document the covered spans, joined where they touch, and the contexts that are edges, as start and size.

    A span comes as its start in the upper 32 bits, a mark of edges in the next and its size in the rest.
    """
    for batch in batches:
        out: dict[str, list] = {"covered": [], "edges": []}
        lists = batch.column("spans")
        bounds, packed = lists.offsets.to_numpy(), lists.values.to_numpy()
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            every = np.sort(packed[begin:end])
            pairs = np.stack([every >> 32, every & 0x7FFFFFFF], axis=1)
            is_edge = (every >> 31) & 1 == 1
            edge, sure = pairs[is_edge], pairs[~is_edge]
            if len(sure):
                reach = np.maximum.accumulate(sure.sum(axis=1))
                first = np.flatnonzero(np.append(True, sure[1:, 0] > reach[:-1]))
                last = np.append(first[1:], len(sure)) - 1
                sure = np.stack([sure[first, 0], reach[last] - sure[first, 0]], axis=1)
            out["covered"].append(_pack(sure))
            out["edges"].append(_pack(edge))
        columns = [*(batch.column(name) for name in _ROW), *(pa.array(x, pa.binary()) for x in out.values())]
        yield pa.RecordBatch.from_arrays(columns, [*_ROW, "covered", "edges"])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and size of all spans of a packed column; NULL has none."""
    lists = [x or b"" for x in column.to_pylist()]
    spans = np.frombuffer(b"".join(lists), "<i4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists]), spans[:, 0], spans[:, 1]


def _edge_windows(edges: pa.Array, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of all windows of the contexts that are edges."""
    row, start, size = _unpacked(edges)
    windows = size - length + 1
    return np.repeat(row, windows), ragged_ranges(start + offsets[row], windows)


def _windows(length: int, number: int, parts: int, repeated: Broadcast | None = None) -> Callable:
    """The strings of the contexts that are edges, those of one part by their hash, and of these what a filter lets through."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", SCAN_BYTES):
                data, offsets = text_bytes(part.column("text"))
                row, at = _edge_windows(part.column("edges"), offsets, length)
                value = span_hash(span_sums(data), at, at + length)
                if parts > 1:
                    some = np.flatnonzero(value % U64(parts) == U64(number))
                    row, value = row[some], value[some]
                if repeated is not None:
                    some = np.flatnonzero(maybe(repeated, value))
                    row, value = row[some], value[some]
                for begin in range(0, len(row), 50_000):
                    some = slice(begin, begin + 50_000)
                    ids = [part.column(name).take(pa.array(row[some])) for name in _ROW]
                    yield pa.RecordBatch.from_arrays([pa.array(value[some].view(np.int64)), *ids], ["window", *_ROW])

    return scan


def _filtered(repeated: Broadcast) -> Callable:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe(repeated, batch.column("gram").to_numpy().view(U64))))

    return scan


def _removed(length: int, with_text: bool) -> Callable:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", SCAN_BYTES):
                data, offsets = text_bytes(part.column("text"))
                cover = np.zeros(len(data) + 1, np.int64)
                row, start, size = _unpacked(part.column("covered"))
                np.add.at(cover, start + offsets[row], 1)
                np.add.at(cover, start + offsets[row] + size, -1)
                row, at = _edge_windows(part.column("edges"), offsets, length)
                value = span_hash(span_sums(data), at, at + length) if len(at) else np.zeros(0, U64)
                gone = part.column("windows")
                gone_row = np.repeat(np.arange(part.num_rows), gone.value_lengths().fill_null(0).to_numpy())
                # a window is gone if its row lists it
                listed = np.unique(mixed(gone.flatten().to_numpy().view(U64)) + gone_row.astype(U64))
                hit = at[np.isin(mixed(value) + row.astype(U64), listed)]
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + length, -1)
                gone_bytes = np.cumsum(cover[:-1]) > 0
                opens = gone_bytes.copy()
                opens[1:] &= ~gone_bytes[:-1]
                inner = offsets[:-1][np.diff(offsets) > 0]
                opens[inner] = gone_bytes[inner]
                owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                n_removed = np.bincount(owner[gone_bytes], minlength=part.num_rows)
                n_spans = np.bincount(owner[opens], minlength=part.num_rows)
                kept = [data[a:b][~gone_bytes[a:b]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array(n_removed),
                    pa.array(n_spans),
                    pa.array([_digest(k) for k in kept], pa.string()),
                ]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    # a cut through a letter leaves bytes that are no text; they become the replacement character
                    columns.append(pa.array([k.tobytes().decode("utf-8", "replace") for k in kept], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return scan


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept_text``.

    Texts are UTF-8 bytes, NULL is empty. A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller id; strings are judged on the input. Rows without id lose nothing and take nothing; rows that
    repeat an id don't take from each other, and each is cut by its own strings, whatever text the others have.

    Every string of ``length`` bytes has an anchor, the least of its grams, so that equal strings have equal anchors.
    1. Anchors whose gram occurs in two documents go on; the others, most of them, are left behind by a filter of fixed
       size. 2. An anchor with its context, all strings that have it, is covered where an earlier document has the same
       context. 3. Where one gram has several contexts, the earliest document of each context lists its strings, and
       those that an earlier document lists too are gone. Every step is a sum and a join on hashes of 64 bits, so hot
       passages are partial sums and split joins, and no list of pairs is ever made. What was found of each document is
       broadcast to the texts when it is measured to be small, and joined with them by a shuffle otherwise.

    Steps 2 and 3 work on slices by hash, one after the other, and what they leave is deleted once it has been used, so
    the disk holds the contexts of a large table once and the shuffles of a slice of them.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes = plain.where("doc_id IS NOT NULL").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    text_hash = F.xxhash64("text")
    several_texts = plain.groupBy("doc_id").agg(F.min(text_hash).alias("low"), F.max(text_hash).alias("high")).where("doc_id IS NOT NULL AND low < high")
    several_texts = stored(several_texts.select("doc_id", F.lit(True).alias("has_several")), "several-texts")
    plain = plain.join(_small(several_texts, "8"), "doc_id", "left").select("doc_id", F.when(F.col("has_several"), text_hash).alias("text_key"), "text")
    known = plain.where("doc_id IS NOT NULL")
    grams = known.mapInArrow(giving_back(_grams(length)), "gram long").repartition("gram").sortWithinPartitions("gram")
    of_grams = new_folder(spark, "repeated-grams")
    repeated = kept_in(grams.mapInArrow(_repeats, "gram long"), of_grams)
    spans, folders = _spans(known, repeated, length, n_bytes)
    remove(spark, of_grams)
    lists = spans.groupBy(*_ROW).agg(F.collect_list("span").alias("spans"))
    plan = stored(lists.mapInArrow(_packed, f"{_ROW_SCHEMA}, covered binary, edges binary"), "spans")
    strings = F.col("span").bitwiseAND(F.lit(_EDGE - 1)) - length + 1
    strings = spans.where(F.col("span").bitwiseAND(F.lit(_EDGE)) != 0).agg(F.coalesce(F.sum(strings), F.lit(0)).alias("n")).first()["n"]
    for folder in folders:
        remove(spark, folder)
    opened = _with_found(plain, plan, "octet_length(covered) + octet_length(edges)", "left")
    listing = _with_found(plain, plan.select(*_ROW, "edges").where("octet_length(edges) > 0"), "octet_length(edges)", "inner")
    gone, folders = _gone(listing, length, max(1, -(-strings // max(LISTED_STRINGS, n_bytes // LISTED_SHARE))))
    gone = stored(gone.groupBy(*_ROW).agg(F.collect_set("window").alias("windows")), "gone-windows")
    for folder in folders:
        remove(spark, folder)
    final = _with_found(opened, gone, "8 * size(windows)", "left")
    return final.mapInArrow(giving_back(_removed(length, with_text)), _RESULT + ", kept_text string" * with_text)


def _spans(known: DataFrame, repeated: DataFrame, length: int, n_bytes: int) -> tuple[DataFrame, list[str]]:
    """Spans that are covered, and contexts that are edges (marked), by row; and the folders that they are read from."""
    spark, slices = known.sparkSession, min(MOST_SLICES, max(1, -(-n_bytes // SLICE_BYTES)))
    of_slice = F.pmod(F.col("gram"), F.lit(slices)).cast("int")
    shared, folder = bloom(repeated, "gram"), new_folder(spark, "contexts")
    contexts = known.mapInArrow(giving_back(_contexts(shared, length, slices)), f"{_ROW_SCHEMA}, gram long, context long, span long")
    contexts = kept_by(contexts.withColumn("slice", of_slice), folder, "slice", slices)
    shared.destroy()
    crowded = slices > 1 and repeated.count() > CROWDED_GRAMS
    spans, folders = [], []
    for number in range(slices):
        found, used = contexts.where(F.col("slice") == number).drop("slice"), []
        if crowded:
            shared = bloom(repeated.where(of_slice == number), "gram")
            used.append(new_folder(spark, "slice"))
            found = kept_in(found.mapInArrow(_filtered(shared), found.schema), used[-1])
            shared.destroy()
        used.append(new_folder(spark, "context-firsts"))
        first = found.groupBy("context").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min("gram").alias("gram"))
        first = kept_in(first, used[-1])
        several = first.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1").select("gram", F.lit(True).alias("several"))
        marked = first.join(several, "gram", "left").where("several OR first < last").select("context", "first", "several")
        some = found.select(*_ROW, "context", "span").join(marked, "context").where("first < doc_id OR several")
        edge = F.when(F.col("first") == F.col("doc_id"), F.lit(_EDGE).cast("long")).otherwise(F.lit(0).cast("long"))
        folders.append(new_folder(spark, "slice-spans"))
        spans.append(kept_in(some.select(*_ROW, (F.col("span") + edge).alias("span")), folders[-1]))
        for each in used:
            remove(spark, each)
    remove(spark, folder)
    return reduce(DataFrame.union, spans), folders


def _gone(listing: DataFrame, length: int, parts: int) -> tuple[DataFrame, list[str]]:
    """The listed strings of each row that an earlier document lists too, and the folders that they are read from."""
    spark, gone, folders = listing.sparkSession, [], []
    for number in range(parts):
        windows = listing.mapInArrow(giving_back(_windows(length, number, parts)), f"window long, {_ROW_SCHEMA}")
        firsts = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
        of_firsts = new_folder(spark, "window-firsts")
        firsts = kept_in(firsts.select("window", "first"), of_firsts)
        shared = bloom(firsts, "window")
        again = listing.mapInArrow(giving_back(_windows(length, number, parts, shared)), f"window long, {_ROW_SCHEMA}")
        folders.append(new_folder(spark, "part-windows"))
        gone.append(kept_in(again.join(firsts, "window").where("first < doc_id").select("window", *_ROW), folders[-1]))
        shared.destroy()
        remove(spark, of_firsts)
    return reduce(DataFrame.union, gone), folders


def _with_found(texts: DataFrame, found: DataFrame, row_bytes: str, how: str) -> DataFrame:
    """Texts with what was found of their rows."""
    named = found.withColumnsRenamed({name: f"of_{name}" for name in _ROW})
    same = (F.col("doc_id") == F.col("of_doc_id")) & F.col("text_key").eqNullSafe(F.col("of_text_key"))
    return texts.join(_small(named, row_bytes), same, how).drop(*[f"of_{name}" for name in _ROW])


def _small(df: DataFrame, row_bytes: str) -> DataFrame:
    """A stored frame with a broadcast hint if the sum of its rows is within the limit."""
    size = df.agg(F.expr(f"coalesce(sum({ROW_OVERHEAD_BYTES} + {row_bytes}), 0) AS n")).first()["n"]
    return hinted(df, size)


@query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
