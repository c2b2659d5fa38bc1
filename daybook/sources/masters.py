"""Master tables: unique keys, active rows only, broadcast where their measured size allows it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import hinted, measured_bytes

# Fixed value: status of an account in use.
ACTIVE_STATUS = "1"


@dataclass(frozen=True)
class Masters:
    """Unique keys of the masters, named like the posting columns they validate."""

    branches: DataFrame
    currencies: DataFrame
    rates: DataFrame
    cgls: DataFrame


def branch_keys(branches: DataFrame) -> DataFrame:
    return branches.select(F.col("CODE").alias("BRANCH_CODE")).distinct()


def currency_keys(currencies: DataFrame) -> DataFrame:
    return currencies.select(F.col("CURRENCY_CODE").alias("CURRENCY")).distinct()


def currency_rates(currencies: DataFrame) -> DataFrame:
    return currencies.groupBy("CURRENCY_CODE").agg(F.max("CURRENCY_RATE").alias("CURRENCY_RATE"))


def cgl_keys(cgls: DataFrame) -> DataFrame:
    return cgls.select(F.col("CGL_NUMBER").alias("CGL")).distinct()


def circle_keys(circles: DataFrame) -> DataFrame:
    return circles.filter(F.col("BRANCH_CODE").isNotNull()).select("BRANCH_CODE").distinct()


def flagged_cgls(cgls: DataFrame, flag: str) -> DataFrame:
    """Accounts whose flag (BAL_COMPARE, BAL_FWD) is 1; codes trimmed by the join that uses them."""
    return cgl_keys(cgls.filter(F.col(flag) == 1))


def load_masters(
    branches: DataFrame,
    currencies: DataFrame,
    cgls: DataFrame,
    active_only: bool = True,
) -> Masters:
    """The masters of the ledger balance, measured by one small job that decides on their broadcast.

    Measured are the rows before they are made unique: that bounds the size from above and takes no shuffle.
    """
    active = cgls.filter(F.col("STATUS") == ACTIVE_STATUS) if active_only else cgls
    sizes = measured_bytes(
        branches.select("CODE"), currencies.select("CURRENCY_CODE", "CURRENCY_RATE"), active.select("CGL_NUMBER")
    )
    of_branches, of_currencies, of_cgls = sizes
    return Masters(
        branches=hinted(branch_keys(branches), of_branches),
        currencies=hinted(currency_keys(currencies), of_currencies),
        rates=hinted(currency_rates(currencies), of_currencies),
        cgls=hinted(cgl_keys(active), of_cgls),
    )
