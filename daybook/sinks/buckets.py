"""Slices divided into buckets by key, so that a merge of few keys reads and writes few files.

A slice lies in ``<path>/<column>=<date>/bucket=<n>``; the bucket of a row is a hash of its keys. A merge looks at the
buckets that its rows fall into, and leaves the files of the others as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import BROADCAST_LIMIT_BYTES, checkpointed, measured_bytes
from daybook.sinks.lake import merged_slice
from daybook.sources.lake import data_file

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, path: str, keys: Sequence[str], column: str, day: dt.date, buckets: int) -> None:
    """Replace the slice of a date by rows in buckets; other dates stay.

    Rows are brought together by bucket and a hash of the row, so a bucket with much of the data is not one task.
    """
    placed = rows.drop(column).withColumns({column: F.lit(day), BUCKET: bucket_of(keys, buckets)})
    _overwrite(placed.hint("rebalance", F.col(BUCKET)), path, column)


def _overwrite(rows: DataFrame, path: str, column: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column, BUCKET).parquet(path)


def read_buckets(
    spark: SparkSession, path: str, column: str, day: dt.date, only: Sequence[int] | None = None
) -> DataFrame | None:
    """The slice of a date, or of some of its buckets, with the number of the bucket; None when there are no files."""
    folders = [f"{path}/{column}={day}"] if only is None else [f"{path}/{column}={day}/{BUCKET}={n}" for n in only]
    folders = [folder for folder in folders if data_file(spark, folder) is not None]
    if not folders:
        return None
    rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.withColumns({column: F.col(column).cast("date"), BUCKET: F.col(BUCKET).cast("int")})


def merged_buckets(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str], limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Rows of the touched buckets after a merge, as ``lake.merged_slice`` defines it.

    A source whose measured size is within ``limit`` is broadcast, and the slice is not exchanged at all: its rows take
    new values in place, and of the source the keys that were found are left out of what is added. A larger source is
    merged by a shuffle of both.
    """
    (size,) = measured_bytes(source)
    if size > limit:
        return merged_slice(target, source, keys, values)
    new = F.broadcast(source.select(*keys, F.struct(*values).alias("_new")))
    types = {f.name: f.dataType for f in target.schema.fields}

    def updated(name: str) -> Column:
        fresh = F.coalesce(F.col(f"_new.{name}"), F.lit(0))
        return F.when(F.col("_new").isNotNull(), fresh).otherwise(F.col(name)).cast(types[name]).alias(name)

    kept = target.join(new, list(keys), "left").select(*keys, *[updated(v) for v in values])
    found = target.join(F.broadcast(source.select(*keys)), list(keys), "left_semi").select(*keys)
    added = source.join(found, list(keys), "left_anti")
    return kept.unionByName(added.select(*keys, *[F.col(v).cast(types[v]).alias(v) for v in values]))


def upsert_buckets(
    source: DataFrame, path: str, keys: Sequence[str], values: Sequence[str], column: str, day: dt.date, buckets: int
) -> list[int]:
    """Merge rows (one per key) into the slice of a date; the numbers of the buckets that were written.

    Only buckets with a key of the source are read and replaced. There are ``buckets`` of them at most, so their numbers
    are collected. The number of buckets of a table is fixed by its first write and must be given again.
    """
    spark = source.sparkSession
    held = checkpointed(source.select(*keys, *values))
    touched = sorted(r[0] for r in held.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect())
    if not touched:
        return []
    target = read_buckets(spark, path, column, day, touched)
    rows = held if target is None else merged_buckets(target.select(*keys, *values), held, keys, values)
    placed = rows.withColumns({column: F.lit(day), BUCKET: bucket_of(keys, buckets)})
    # a bucket that is read and written in one job is safe: the files are swapped after the last task
    _overwrite(placed, path, column)
    return touched
