"""Lake tables on date-partitioned parquet.

A slice is the partition of one date. Replacing it is idempotent, so every job can be rerun for its date, and Spark
commits it only after all tasks have succeeded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.sources.lake import empty_frame, find_slice, table_shape

# Postings that a rerun creates again, unlike journals and reversals.
REGENERATED_FLAGS = ("C", "F", "P", "T", "V")


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table, its schema included."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def overwrite_files(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Replace a whole table and its schema in files of even size, none of more than ``rows_per_file`` rows.

    The rows are rebalanced just before the write, into as many parts as their size asks for; what comes before keeps
    its own number of tasks.
    """
    even = df.hint("rebalance").write.option("maxRecordsPerFile", str(rows_per_file))
    even.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def overwrite_parts(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace a whole table that is divided by a few values, in one pass over its rows.

    A task keeps one file open for each value, up to 64, and so does without the sort that a partitioned write needs.
    """
    spark, setting = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64")
    try:
        overwrite(df, path, partition_by)
    finally:
        spark.conf.set(setting, before)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows; new columns are allowed and show up when the table is read with ``merge_schema``."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def _checked(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """The same rows; one of another date fails the job before anything is committed."""
    same = F.coalesce(F.col(column) == F.lit(day), F.lit(False))
    return df.filter(F.coalesce(F.assert_true(same, f"{column} is not {day}").cast("boolean"), F.lit(True)))


def _same_types(df: DataFrame, path: str, column: str) -> None:
    """Refuse rows that would leave a table with slices of two shapes, which can't be read together."""
    present = table_shape(df.sparkSession, path)
    if present is None:
        return
    kinds = {field.name: field.dataType for field in df.schema.fields}
    for field in present.fields:
        if field.name != column and kinds.get(field.name) != field.dataType:
            found = kinds[field.name].simpleString() if field.name in kinds else "no such column"
            raise ValueError(f"{path}: {field.name} is {field.dataType.simpleString()}, the new rows have {found}")


def replace_slice(df: DataFrame, path: str, column: str, day: dt.date) -> int:
    """Replace the rows of one date and return their number; an empty frame empties the date.

    Rows without a column of the table, or with another type of it, are refused before anything is written.

    The row count is observed during the write, so an empty frame costs no second pass. The date is put on last, as a
    constant, which spares the sort by partition that a partitioned write would need.
    """
    _same_types(df, path, column)
    written = Observation()
    counted = _checked(df, column, day).observe(written, F.count(F.lit(1)).alias("rows"))
    dated = counted.withColumn(column, F.lit(day))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    rows = written.get["rows"]
    if rows == 0:
        # A dynamic overwrite leaves the old partition in place when it gets no rows.
        _clear_partition(df.sparkSession, df.drop(column).schema, path, column, day)
    return rows


def _clear_partition(spark: SparkSession, schema, path: str, column: str, day: dt.date) -> None:
    empty = empty_frame(spark, schema)
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{column}={day}")


def delete_slice(spark: SparkSession, path: str, column: str, day: dt.date) -> None:
    """Remove the rows of one date; nothing happens when the table or the date is absent."""
    rows = find_slice(spark, path, column, day)
    if rows is not None and not rows.isEmpty():
        _clear_partition(spark, rows.drop(column).schema, path, column, day)


def merged_slice(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of a slice after a merge: matched rows take the source value or 0, new rows come in as they are.

    The source must have one row per key, as balances have.
    """
    old = target.select(*keys, F.struct(*values).alias("_old"))
    new = source.select(*keys, F.struct(*values).alias("_new"))
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def merged(name: str) -> Column:
        fresh, kept = F.col(f"_new.{name}"), F.col(f"_old.{name}")
        return F.when(matched, F.coalesce(fresh, F.lit(0))).when(F.col("_new").isNotNull(), fresh).otherwise(kept)

    joined = old.join(new, list(keys), "full_outer")
    kept_types = {f.name: f.dataType for f in target.schema.fields}
    return joined.select(*keys, *[merged(v).cast(kept_types[v]).alias(v) for v in values])


def upsert_slice(
    source: DataFrame, path: str, keys: Sequence[str], values: Sequence[str], column: str, day: dt.date
) -> int:
    """Merge rows into the slice of one date.

    The old slice is read by the very job that replaces it. That is safe: the dynamic overwrite writes to a staging
    folder and swaps the partition after the last task.
    """
    spark = source.sparkSession
    target = find_slice(spark, path, column, day)
    if target is None:
        target = empty_frame(spark, source.schema)
    rows = merged_slice(target, source, keys, values).withColumn(column, F.lit(day))
    return replace_slice(rows, path, column, day)


def purged(
    transactions: DataFrame, day: dt.date, column: str = "TRANSACTION_DATE", flags: Sequence[str] = REGENERATED_FLAGS
) -> DataFrame:
    """Transactions without those of the date that a rerun creates again."""
    regenerated = (F.col(column) == F.lit(day)) & F.col("SOURCE_FLAG").isin(*flags)
    return transactions.filter(~F.coalesce(regenerated, F.lit(False)))


def purge_rerun(spark: SparkSession, day: dt.date, transactions: str, whole_slices: Mapping[str, str]) -> None:
    """Before a rerun: drop regenerated transactions of the date, and the date of every table in ``whole_slices``.

    ``whole_slices`` maps a table path to its date column (balances, quarantined postings, lake balances).
    """
    rows = find_slice(spark, transactions, "TRANSACTION_DATE", day)
    if rows is not None:
        replace_slice(purged(rows, day), transactions, "TRANSACTION_DATE", day)
    for path, column in whole_slices.items():
        delete_slice(spark, path, column, day)


def update_control_status(control_path: str, updated: DataFrame, column: str, day: dt.date) -> int:
    """Write the control rows of one date back with their counts and status (``rowcounts.apply_status``)."""
    return replace_slice(updated, control_path, column, day)

