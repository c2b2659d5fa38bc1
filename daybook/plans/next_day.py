"""Opening of the next day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from daybook.operators import openings as op
from daybook.session import checkpointed
from daybook.sinks import lake


def run_next_day(
    closing: DataFrame,
    day: dt.date,
    forward_cgls: DataFrame,
    circle_branches: DataFrame,
    calendar: DataFrame,
    lake_table: str,
    balance_table: str,
) -> DataFrame:
    """Write the opening balances of the next day into the lake table and the balance table.

    Both get the date replaced, so a rerun does not double it; an inactive year end leaves an empty date.
    """
    opening = checkpointed(op.open_next_day(closing, day, forward_cgls, circle_branches, calendar))
    write_opening(opening, day, lake_table, balance_table)
    return opening


def write_opening(opening: DataFrame, day: dt.date, lake_table: str, balance_table: str) -> None:
    following = day + dt.timedelta(days=1)
    lake.replace_slice(op.lake_opening_rows(opening), lake_table, "BALANCE_DATE", following)
    lake.replace_slice(op.table_opening_rows(opening), balance_table, "BALANCE_DATE", following)
