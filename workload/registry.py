"""Registered queries. A name ends in the identifier of the operator it shows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daybook.functions import decode_overpunch
from daybook.functions.amounts import LEDGER_WIDTH
from daybook.operators.movements import aggregate_movements, exclude_file_types
from daybook.sources.masters import Masters, load_masters
from workload import fixtures


@dataclass(frozen=True)
class Inputs:
    """The inputs of a query on one directory of tables."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, name)

    def base(self, table: str) -> DataFrame:
        return fixtures.base_table(self.spark, self.sf_dir, table)

    def lines(self) -> DataFrame:
        """Ledger lines of the files that count, decoded by this package."""
        raw = exclude_file_types(self("ledger_raw"))
        return raw.withColumn("AMT", decode_overpunch("AMOUNT", LEDGER_WIDTH))

    def postings(self) -> DataFrame:
        return aggregate_movements(self.lines(), "B1")

    def masters(self) -> Masters:
        return load_masters(self("branch_master"), self("currency_master"), self("cgl_master"))


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function, with the SQL it must agree with."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = fixtures.with_views(sql)
        return function

    return register
