"""Opening balances of the next day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import MONEY, compose_glcc, is_year_end
from daybook.functions.amounts import HOME_CURRENCY
from daybook.operators.lookups import flag_known, keep_known_trimmed
from daybook.operators.transfers import PROFIT_CGL, is_income_expense

# Fixed values.
OPENING_COLUMNS = ("CGL", "CURRENCY", "BRANCH_CODE", "BALANCE_DATE", "BALANCE", "INR_BALANCE")


def redated(closing: DataFrame, day: dt.date) -> DataFrame:
    """Closing rows under the date of the next day."""
    return closing.withColumn("BALANCE_DATE", F.lit(day + dt.timedelta(days=1))).select(*OPENING_COLUMNS)


def with_offsets(foreign: DataFrame) -> DataFrame:
    """Each foreign income or expense row together with a home-currency row that offsets it; no shuffle."""
    opposite = F.negate(F.col("INR_BALANCE")).cast(MONEY)
    rows = F.array(
        F.struct(
            F.col("CURRENCY").alias("CURRENCY"),
            F.col("BALANCE").cast(MONEY).alias("BALANCE"),
            F.col("INR_BALANCE").cast(MONEY).alias("INR_BALANCE"),
        ),
        F.struct(
            F.lit(HOME_CURRENCY).alias("CURRENCY"), opposite.alias("BALANCE"), opposite.alias("INR_BALANCE")
        ),
    )
    return foreign.select("CGL", "BRANCH_CODE", "BALANCE_DATE", F.inline(rows)).select(*OPENING_COLUMNS)


def year_end_forward(opening: DataFrame, forward_cgls: DataFrame, circle_branches: DataFrame) -> DataFrame:
    """Year-end rules on re-dated closing rows.

    Only accounts marked for forwarding stay. Of the income and expense accounts only foreign rows stay, each with an
    offset row; the profit account stays at circle branches only. The rows are read twice, each time under a pushed
    filter, and only the foreign income and expense rows are shuffled.
    """
    kept = keep_known_trimmed(opening, forward_cgls, "CGL", "CGL").select(*OPENING_COLUMNS)
    foreign = kept.filter(is_income_expense() & (F.trim(F.col("CURRENCY")) != HOME_CURRENCY)).distinct()
    flagged = flag_known(kept.filter(~is_income_expense()), circle_branches, "BRANCH_CODE", "IS_CIRCLE")
    others = flagged.filter((F.col("CGL") != PROFIT_CGL) | F.col("IS_CIRCLE").isNotNull()).select(*OPENING_COLUMNS)
    return with_offsets(foreign).unionByName(others)


def year_is_active(calendar: DataFrame) -> Column:
    """Whether the calendar has an active year, as an uncorrelated EXISTS that Spark answers before the scan."""
    return calendar.filter(F.col("ACTIVE_FLAG") == 1).exists()


def open_next_day(
    closing: DataFrame, day: dt.date, forward_cgls: DataFrame, circle_branches: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Opening balances of the day after ``day``; at year end without an active calendar year there are none."""
    opening = redated(closing, day)
    if not is_year_end(day):
        return opening
    forwarded = year_end_forward(opening, forward_cgls, circle_branches)
    return forwarded.filter(year_is_active(calendar))


def lake_opening_rows(opening: DataFrame) -> DataFrame:
    """Opening balances in the shape of the lake table."""
    return opening.select(
        compose_glcc().alias("glcc"),
        F.col("BALANCE").cast(MONEY).alias("closing_balance"),
        F.col("INR_BALANCE").cast(MONEY).alias("INR_BALANCE"),
        "BALANCE_DATE",
    )


def table_opening_rows(opening: DataFrame) -> DataFrame:
    """Opening balances in the shape of the database table."""
    money = {name: F.col(name).cast(MONEY) for name in ("BALANCE", "INR_BALANCE")}
    return opening.withColumns(money).select(*OPENING_COLUMNS)
