"""Business-date helpers. None of them reads the clock: dates come from the caller."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.amounts import as_column

# Day zero of the serial dates, and the turn of the financial year.
SERIAL_DAY_ZERO = dt.date(1899, 12, 31)
YEAR_END = (3, 31)
YEAR_START = (4, 1)


def serial_day(days: Column | str) -> Column:
    """Serial day number to date; NULL when it is not a number."""
    return F.date_add(F.lit(SERIAL_DAY_ZERO), as_column(days).try_cast("int"))


def clock_from_millis(millis: Column | str) -> Column:
    """Milliseconds of the day to ``HH:mm:ss``."""
    seconds = F.floor(as_column(millis).try_cast("bigint") / 1000)
    parts = (F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)
    shown = [F.lpad(p.cast("string"), 2, "0") for p in parts]
    return F.concat(shown[0], F.lit(":"), shown[1], F.lit(":"), shown[2])


def is_month_end(day: dt.date) -> bool:
    return (day + dt.timedelta(days=1)).day == 1


def is_year_end(day: dt.date) -> bool:
    return (day.month, day.day) == YEAR_END


def is_financial_year_start(day: dt.date) -> bool:
    return (day.month, day.day) == YEAR_START
