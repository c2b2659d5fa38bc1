"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import LETTER_DIGIT_BYTES, LOWER_ASCII, Words, chunks, giving_back, gram_hash, ragged_ranges, stored, table, text_bytes, words
from daybook.llm.registry import query

WINDOW = 13
GRAM = 5
BROADCAST_LIMIT_BYTES = 32 << 20
MATCHES_AT_ONCE = 200_000
_MOST = np.iinfo(np.uint64).max
_RESULT = "n_words long, n_hit long, item_ids array<string>"


def text_words(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    return words(LOWER_ASCII[data], offsets, LETTER_DIGIT_BYTES)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``pick`` over each ``width`` neighbours from a place on; beyond the end stands ``fill``."""
    done, line = 1, values
    while done < width:
        step = min(done, width - done)
        moved = np.full_like(line, fill)
        moved[: len(line) - step] = line[step:]
        line = pick(line, moved)
        done += step
    return line


def winnowed(text: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the grams that are the least of some ``window - gram + 1`` neighbouring grams.

    Ties are all taken. Any ``window`` consecutive words hold at least one of them, chosen by those words alone.
    """
    count = len(text.hash) - gram + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hash(text.hash, gram)
    crosses = text.row[:count] != text.row[gram - 1 :]
    grams[crosses] = _MOST
    width = window - gram + 1
    least = _sliding(grams, width, np.minimum, _MOST)
    # the largest of the minima of all windows that hold a place
    above = _sliding(least[::-1], width, np.maximum, np.uint64(0))[::-1]
    chosen = np.flatnonzero((grams == above) & ~crosses)
    return chosen, grams[chosen]


class Items:
    """Benchmark items as word hashes, with an index of their fingerprints."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int, gram: int) -> None:
        text = text_words(texts)
        self.ids, self.window, self.gram = np.array(ids, object), window, gram
        self.hash, self.row, self.first, counts = text.hash, text.row, text.first, text.counts
        place, key = winnowed(text, window, gram)
        long = counts[text.row[place]] >= window
        order = np.argsort(key[long], kind="stable")
        self.key, self.place = key[long][order], place[long][order]
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        for size in sorted(set(counts[(counts > 0) & (counts < window)].tolist())):
            rows = np.flatnonzero(counts == size)
            keys = gram_hash(self.hash, size)[self.first[rows]]
            order = np.argsort(keys, kind="stable")
            self.short.append((size, keys[order], rows[order]))


def _pairs(index: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in ``keys``, place in the sorted ``index``) of equal keys."""
    low, high = np.searchsorted(index, keys, "left"), np.searchsorted(index, keys, "right")
    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    return np.repeat(found, counts), ragged_ranges(low[found], counts)


def find_hits(docs: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Which words of the documents are hit, and the distinct (row, item) pairs as ``row * items + item``."""
    window, n_items = items.window, max(1, len(items.ids))
    hit = np.zeros(len(docs.hash) + 1, np.int64)
    seen = [np.zeros(0, np.int64)]

    def mark(start: np.ndarray, size: int, row: np.ndarray, item: np.ndarray) -> None:
        np.add.at(hit, start, 1)
        np.add.at(hit, start + size, -1)
        seen.append(np.unique(row * n_items + item))

    place, key = winnowed(docs, window, items.gram)
    at, other = _pairs(items.key, key)
    reach = np.arange(items.gram - window, window)
    for begin in range(0, len(at), MATCHES_AT_ONCE):
        here, there = place[at[begin : begin + MATCHES_AT_ONCE]], items.place[other[begin : begin + MATCHES_AT_ONCE]]
        row, item = docs.row[here], items.row[there]
        mine, its = here[:, None] + reach, there[:, None] + reach
        inside = (mine >= docs.first[row][:, None]) & (mine < docs.first[row + 1][:, None])
        inside &= (its >= items.first[item][:, None]) & (its < items.first[item + 1][:, None])
        equal = inside & (docs.hash[np.where(inside, mine, 0)] == items.hash[np.where(inside, its, 0)])
        match, shift = np.nonzero(sliding_window_view(equal, window, axis=1).all(axis=2))
        mark(here[match] + reach[shift], window, row[match], item[match])
    for size, keys, rows in items.short:
        if len(docs.hash) >= size:
            last = len(docs.hash) - size + 1
            grams = gram_hash(docs.hash, size)
            start, other = _pairs(keys, grams)
            whole = docs.row[start] == docs.row[start + size - 1] if last else np.zeros(0, bool)
            start, other = start[whole], other[whole]
            mark(start, size, docs.row[start], rows[other])
    return np.cumsum(hit[:-1]) > 0, np.unique(np.concatenate(seen))


def _scored(docs: Words, rows: int, items: Items) -> list[pa.Array]:
    hit, pairs = find_hits(docs, items)
    n_hit = np.bincount(docs.row[hit], minlength=rows)
    named: list[list[str]] = [[] for _ in range(rows)]
    for pair in pairs.tolist():
        named[pair // max(1, len(items.ids))].append(items.ids[pair % max(1, len(items.ids))])
    named = [sorted(set(x)) for x in named]
    return [pa.array(docs.counts), pa.array(n_hit), pa.array(named, pa.list_(pa.string()))]


def _match_batches(shared: object, window: int, gram: int, text: str) -> Callable:
    @giving_back
    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = shared.value
        items = Items(ids, pa.array(texts, pa.string()), window, gram)
        for batch in batches:
            for part in chunks(batch, text):
                scored = _scored(text_words(part.column(text)), part.num_rows, items)
                kept = [part.column(name) for name in part.schema.names if name != text]
                names = [name for name in part.schema.names if name != text]
                yield pa.RecordBatch.from_arrays([*kept, *scored], [*names, "n_words", "n_hit", "item_ids"])

    return match


def _fingerprints(window: int, gram: int) -> Callable:
    """Fingerprints of whole texts, and the grams of all sizes below ``window``."""

    @giving_back
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                text = text_words(part.column("text"))
                key = part.column("key")
                place, value = winnowed(text, window, gram)
                found = [(window, place, value)]
                for size in range(1, window):
                    if len(text.hash) >= size:
                        start = np.flatnonzero(text.row[: len(text.hash) - size + 1] == text.row[size - 1 :])
                        found.append((size, start, gram_hash(text.hash, size)[start]))
                for size, start, value in found:
                    columns = [key.take(pa.array(text.row[start])), pa.array(np.full(len(start), size, np.int32)), pa.array(value.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "size", "gram"])

    return emit


def _match_pairs(window: int, gram: int) -> Callable:
    """Exact word places that each candidate pair of texts shares."""

    @giving_back
    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                docs = text_words(pa.array([row["text"]], pa.string()))
                items = Items([row["item_id"]], pa.array([row["item_text"]], pa.string()), window, gram)
                hit, pairs = find_hits(docs, items)
                if len(pairs):
                    out.append((row["key"], row["item_id"], np.flatnonzero(hit).tolist()))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            kinds = (pa.string(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "item_id", "places"])

    return match


@giving_back
def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            counts = text_words(part.column("text")).counts
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(counts)], ["key", "n_words"])


def _joined(docs: DataFrame, items: DataFrame, text: str, window: int, gram: int) -> DataFrame:
    """The hits by shuffled joins of fingerprints, for a benchmark of any size. Equal texts are looked at once."""
    key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    texts = docs.select(key.alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["key"])
    texts = stored(texts, "texts")
    counted = texts.mapInArrow(_count_words, "key string, n_words long")
    named = items.groupBy("item_id", "text").agg(F.xxhash64("item_id", "text").alias("item_key"))
    named = stored(named.withColumn("key", F.col("item_key").cast("string")), "items")
    marks = "key string, size int, gram long"
    short = named.select("key", "text").mapInArrow(_count_words, "key string, n_words long")
    sizes = short.where("n_words > 0").select("key", F.least("n_words", F.lit(window)).cast("int").alias("size"))
    theirs = named.select("key", "text").mapInArrow(_fingerprints(window, gram), marks).join(sizes, ["key", "size"]).distinct()
    used = [row["size"] for row in sizes.select("size").distinct().collect()]
    mine = texts.mapInArrow(_fingerprints(window, gram), marks).where(F.col("size").isin(used)).distinct()
    pairs = mine.join(theirs.withColumnRenamed("key", "item"), ["size", "gram"]).select("key", "item").distinct()
    whole = pairs.join(texts, "key").join(named.select(F.col("key").alias("item"), "item_id", F.col("text").alias("item_text")), "item")
    hits = stored(
        whole.select("key", "text", "item_id", "item_text").mapInArrow(_match_pairs(window, gram), "key string, item_id string, places array<long>"),
        "hits",
    )
    places = hits.select("key", F.explode("places").alias("place")).distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    names = hits.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = counted.join(places, "key", "left").join(names, "key", "left")
    found = found.select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )
    return docs.withColumn("match_key", key).join(found.withColumnRenamed("key", "match_key"), "match_key").drop("match_key")


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    limit: int = BROADCAST_LIMIT_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``item_ids`` and ``contaminated``, with or without the text column.

    Words are runs of letters and digits after lower-casing A-Z; NULL and empty texts have none. Every ``window``
    consecutive words of an item, or all words of a shorter item, are looked for in every document; the words of each
    occurrence are hit. Fingerprints are the least gram hash of each window, so every shared window shares one; matches
    are then extended word by word. Items without id or words are passed over; items that repeat an id count once.
    Columns of the documents with the names of the results are replaced.

    A benchmark of at most ``limit`` bytes, measured first, goes to every task and the documents are read once without
    a shuffle. A larger one is joined by fingerprint.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item_id") + 16), F.lit(0)).alias("n")).first()["n"]
    plain = docs.drop("n_words", "n_hit", "item_ids", "contaminated")
    if size <= limit:
        rows = items.collect()
        shared = spark.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))
        renamed = plain.withColumn("match_text", F.col(text))
        plain, renamed = (plain, renamed) if keep_text else (plain.drop(text), renamed.drop(text))
        schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in plain.schema.fields)
        found = renamed.mapInArrow(_match_batches(shared, window, gram, "match_text"), f"{schema}, {_RESULT}")
    else:
        found = _joined(plain, items, text, window, gram)
        found = found if keep_text else found.drop(text)
    return found.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


@query(r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM lowered, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, i, d.size FROM doc_windows d JOIN item_windows USING (size, gram)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT l.doc_id, len(l.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(l.w) AS contaminated
FROM lowered l LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )
