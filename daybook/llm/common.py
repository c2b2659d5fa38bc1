"""What several corpus operators share: reading, storing between steps, and words of text as arrays of bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from daybook.session import new_folder

BLANK = r"\x20\x09-\x0D"
CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(spark: SparkSession) -> None:
    """Have the shuffle files of finished work deleted.

    Spark does it when the driver collects its garbage, which a driver with little to do puts off for long.
    """
    spark._jvm.System.gc()


def kept_in(df: DataFrame, folder: str) -> DataFrame:
    """Write a frame to a folder and read it again; shuffle files that it no longer needs go."""
    df.write.option("compression", "zstd").parquet(folder)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def kept_by(df: DataFrame, folder: str, column: str, values: int) -> DataFrame:
    """:func:`kept_in` with a folder for each value of a column of few values, which tasks write side by side, not sorted."""
    conf = df.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(values))
    try:
        df.write.option("compression", "zstd").partitionBy(column).parquet(folder)
    finally:
        conf.set(WRITERS, before)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it again: computed once, safe when executors are lost."""
    return kept_in(df, new_folder(df.sparkSession, label))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return memory that is free to the system; the C library keeps it otherwise, where it knows ``malloc_trim`` at all."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(scan: Callable) -> Callable:
    """A scan of batches after whose partition the worker, which stays for later tasks, keeps no more than it needs."""

    @wraps(scan)
    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return scanned


# ---- words as arrays of bytes

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
LETTER_DIGIT_BYTES = np.zeros(256, bool)
LETTER_DIGIT_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over their range (the finaliser of splitmix64)."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``length`` of each."""
    if len(_powers["up"]) < length:
        size = max(length, 2 * CHUNK_BYTES)
        for name, factor in (("up", _BASE), ("down", _BASE_INVERSE)):
            line = np.full(size, factor, U64)
            line[0] = 1
            _powers[name] = np.cumprod(line, dtype=U64)
    return _powers["up"], _powers["down"]


def span_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any span of ``data``."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from each start to each end; equal spans have equal hashes wherever they lie."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, NULL as empty, and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text; a longer row stands alone and stays whole."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if size and size + length > limit:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if start < len(lengths):
        yield batch.slice(start)


@dataclass
class Words:
    """The words of consecutive rows: the row, first byte and end of each, its hash, and the first word of each row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of the bytes that ``is_word`` marks; no word reaches across two rows."""
    inside = is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(start, offsets, "left")
    return Words(row, start, end, span_hash(span_sums(data), start, end), first)


def gram_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring word hashes, by its first word."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, U64)
    factor = 1
    for place in range(size):
        total += hashes[place : place + count] * U64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return mixed(total)


def ragged_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one range after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) if len(counts) else starts
    return np.arange(total) + shift
