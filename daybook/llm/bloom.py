"""A Bloom filter of fixed size, built by Spark and tested in Python tasks. It may let too much through, never too little."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import U64, mixed

BITS = 27
HASHES = 4


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of each 64-bit value, and its bits in this word."""
    spread = mixed(values ^ U64(0x5851F42D4C957F2D))
    bits = np.zeros(len(values), U64)
    for turn in range(HASHES):
        bits |= U64(1) << ((spread >> U64(6 * turn)) & U64(63))
    return spread >> U64(64 - (BITS - 6)), bits


def _words(column: str) -> Callable:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITS - 6), U64)
        for batch in batches:
            np.bitwise_or.at(bits, *_places(batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)))
        used = np.flatnonzero(bits)
        for begin in range(0, len(used), 100_000):
            some = used[begin : begin + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(bits[some].view(np.int64))], ["word", "bits"])

    return scan


def bloom(values: DataFrame, column: str) -> Broadcast:
    """A broadcast filter of a long column: ``2 ** BITS`` bits (16 MB) however many values there are."""
    words = values.select(F.col(column).cast("long").alias(column)).mapInArrow(_words(column), "word int, bits long")
    found = words.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), U64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(U64)
    return values.sparkSession.sparkContext.broadcast(bits)


def maybe(shared: Broadcast, values: np.ndarray) -> np.ndarray:
    """False where a value was certainly not among those of the filter."""
    word, bits = _places(values)
    return shared.value[word] & bits == bits
