"""From postings to closing balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import MONEY, RATED_MONEY, compose_glcc, is_financial_year_start, is_month_end, split_glcc
from daybook.functions.amounts import HOME_CURRENCY
from daybook.operators.lookups import with_rate
from daybook.operators.postings import net

# Column order of the two balance tables.
BALANCE_COLUMNS = ("CGL", "CURRENCY", "BRANCH_CODE", "BALANCE", "INR_BALANCE", "BALANCE_DATE")
LAKE_BALANCE_COLUMNS = ("glcc", "closing_balance", "INR_BALANCE", "BALANCE_DATE")


def movement_balances(postings: DataFrame) -> DataFrame:
    """Key and balance of every posting."""
    return postings.select(compose_glcc().alias("glcc"), net().alias("BALANCE"))


def opening_source(day: dt.date, run_no: int) -> tuple[str, dt.date]:
    """Which table and which of its dates hold the opening balance.

    The first run of a day finds the slice that yesterday's roll-forward wrote under today's date; a rerun has replaced
    that slice and goes back to yesterday's closing. The financial year starts from the year-end table.
    """
    if is_financial_year_start(day):
        return "year_end", day
    return "lake", day if run_no == 1 else day - dt.timedelta(days=1)


def lake_opening(lake: DataFrame, day: dt.date) -> DataFrame:
    """Opening balances out of the lake table; only the partition of the date is read."""
    rows = lake.filter(F.col("BALANCE_DATE") == F.lit(day))
    return rows.select("glcc", F.col("closing_balance").cast(MONEY).alias("BALANCE"))


def table_opening(table: DataFrame, day: dt.date) -> DataFrame:
    """Opening balances out of a database-shaped balance table."""
    rows = table.filter(F.col("BALANCE_DATE") == F.lit(day))
    return rows.select(compose_glcc().alias("glcc"), F.col("BALANCE").cast(MONEY).alias("BALANCE"))


def select_opening(lake: DataFrame, year_end: DataFrame, day: dt.date, run_no: int) -> DataFrame:
    """Opening balances for the state of the run."""
    source, slice_day = opening_source(day, run_no)
    return table_opening(year_end, slice_day) if source == "year_end" else lake_opening(lake, slice_day)


def united(movements: DataFrame, opening: DataFrame) -> DataFrame:
    """Bag union of key and balance by position, whatever the two columns are called."""
    return movements.select(movements.columns[:2]).union(opening.select(opening.columns[:2]))


def carry_forward(movements: DataFrame, opening: DataFrame, day: dt.date) -> DataFrame:
    """Closing balance per key: movements of the day plus the opening balance."""
    return (
        united(movements.select("glcc", "BALANCE"), opening.select("glcc", "BALANCE"))
        .groupBy("glcc")
        .agg(F.sum("BALANCE").cast(MONEY).alias("BALANCE"))
        .withColumn("BALANCE_DATE", F.lit(day))
    )


def apply_month_end(closing: DataFrame, postings: DataFrame | None, day: dt.date) -> DataFrame:
    """Add month-end postings to the closing balances; on other days the closing balances stay as they are."""
    if postings is None or not is_month_end(day):
        return closing
    return carry_forward(closing.select("glcc", "BALANCE"), movement_balances(postings), day)


def convert_currency(closing: DataFrame, rates: DataFrame, home: str = HOME_CURRENCY) -> DataFrame:
    """Balances in the reporting currency; the home currency and currencies without a rate convert at 1."""
    parts = closing.select(*[part.alias(name) for name, part in split_glcc("glcc").items()], "BALANCE", "BALANCE_DATE")
    rate = F.when(F.col("CURRENCY") == home, F.lit(1)).otherwise(F.coalesce(F.col("CURRENCY_RATE"), F.lit(1)))
    converted = F.round(F.col("BALANCE") * rate, 2).cast(RATED_MONEY)
    return with_rate(parts, rates).withColumn("INR_BALANCE", converted).select(*BALANCE_COLUMNS)


def lake_balances(balances: DataFrame) -> DataFrame:
    """Balances in the shape of the lake table."""
    return balances.select(
        compose_glcc().alias("glcc"),
        F.col("BALANCE").cast(MONEY).alias("closing_balance"),
        F.col("INR_BALANCE").cast(MONEY).alias("INR_BALANCE"),
        "BALANCE_DATE",
    )
