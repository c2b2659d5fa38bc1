"""Database writes. Connection options come from the caller only and are never logged."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(df: DataFrame, connection: Mapping[str, str], table: str, batch_size: int) -> DataFrameWriter:
    return df.write.format("jdbc").options(**connection).option("dbtable", table).option("batchsize", str(batch_size))


def append_table(df: DataFrame, connection: Mapping[str, str], table: str, batch_size: int = 10_000) -> None:
    """Add rows to a table. Each task commits on its own, so remove the date first when a job is rerun."""
    _writer(df, connection, table, batch_size).mode("append").save()


def overwrite_table(df: DataFrame, connection: Mapping[str, str], table: str, batch_size: int = 10_000) -> None:
    """Replace the rows of a table and keep its definition."""
    _writer(df, connection, table, batch_size).mode("overwrite").option("truncate", "true").save()
