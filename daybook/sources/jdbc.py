"""Database reads. Connection options come from the caller only and are never logged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession


class Parallel(NamedTuple):
    """Split a read over several connections by ranges of a numeric or date column."""

    column: str
    lower: object
    upper: object
    connections: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.connections),
        }


def query_options(
    connection: Mapping[str, str], query: str, parallel: Parallel | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a SQL query used as a table."""
    options = {**connection, "dbtable": f"({query}) t", "fetchsize": str(fetch_size)}
    return options | parallel.options() if parallel else options


def read_query(
    spark: SparkSession, connection: Mapping[str, str], query: str, parallel: Parallel | None = None
) -> DataFrame:
    """Rows of a SQL query that the database runs."""
    return spark.read.format("jdbc").options(**query_options(connection, query, parallel)).load()


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    columns: Sequence[str] = ("*",),
    where: Column | None = None,
    parallel: Parallel | None = None,
) -> DataFrame:
    """Columns and rows of a table; Spark pushes both the projection and the filter into the database."""
    options = {**connection, "dbtable": table, "fetchsize": "10000"}
    if parallel:
        options |= parallel.options()
    rows = spark.read.format("jdbc").options(**options).load()
    return (rows if where is None else rows.filter(where)).select(*columns)
