"""Daily difference between ledger and account balances."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import differences as diff
from daybook.plans.file_ingest import days_between
from daybook.session import checkpointed
from daybook.sinks import lake, steps


@dataclass(frozen=True)
class DifferenceResult:
    differences: DataFrame
    summary: DataFrame


def daily_difference(
    gl: DataFrame, cbs: DataFrame, previous: DataFrame, compared_cgls: DataFrame, day: dt.date
) -> DataFrame:
    """Differences of the day with class, category and first-error date.

    Unmarked accounts are dropped last in the rules; Spark moves that semi join below the category on its own.
    """
    classified = diff.classify_change(diff.balance_difference(gl, cbs), previous, day)
    return diff.restrict_to_master(diff.head_category(classified), compared_cgls)


def run_daily_difference(
    gl: DataFrame,
    cbs: DataFrame,
    previous: DataFrame,
    compared_cgls: DataFrame,
    day: dt.date,
    table: str,
    lake_table: str,
    step_log: str | None = None,
    run_id: str = "",
) -> DifferenceResult:
    """Write the differences of the day to the report table and to the lake table, and return the JSON summary.

    With a step log the end of the step carries the summary; a step that fails is logged as failed.
    """
    with steps.logged_step(gl.sparkSession, step_log, run_id, "daily_difference") as state:
        rows = checkpointed(daily_difference(gl, cbs, previous, compared_cgls, day))
        lake.replace_slice(rows, table, "RECON_RUN_DATE", day)
        lake.replace_slice(diff.lake_differences(rows), lake_table, "RECON_DATE", day)
        summary = diff.difference_summary(rows)
        if step_log is not None:
            state.payload = summary.first()[0]
        return DifferenceResult(rows, summary)


def differences_of_days(
    gl: DataFrame, cbs: DataFrame, previous: DataFrame, compared_cgls: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Daily differences from ``first`` to ``last`` in one job, equal to the runs of the single days one after the other.

    ``gl`` and ``cbs`` have BALANCE_DATE; ``previous`` is what the day before ``first`` left.
    """
    of_days = F.col("BALANCE_DATE").between(F.lit(first), F.lit(last))
    differences = diff.balance_differences_by_day(gl.filter(of_days), cbs.filter(of_days))
    classified = diff.classify_changes(differences, previous, first)
    return diff.restrict_to_master(diff.head_category(classified), compared_cgls)


def run_differences_of_days(
    gl: DataFrame,
    cbs: DataFrame,
    previous: DataFrame,
    compared_cgls: DataFrame,
    first: dt.date,
    last: dt.date,
    table: str,
    lake_table: str,
    step_log: str | None = None,
    run_id: str = "",
) -> DataFrame:
    """Write the differences of a range of days, for a catch-up, into the tables that the daily run writes.

    All days are computed at once; each day's slice is then replaced on its own, also that of a day without differences.
    """
    with steps.logged_step(gl.sparkSession, step_log, run_id, "differences_of_days"):
        rows = checkpointed(
            differences_of_days(gl, cbs, previous, compared_cgls, first, last)
        )
        for day in days_between(first, last):
            of_day = rows.filter(F.col("RECON_RUN_DATE") == F.lit(day))
            lake.replace_slice(of_day, table, "RECON_RUN_DATE", day)
            lake.replace_slice(diff.lake_differences(of_day), lake_table, "RECON_DATE", day)
        return rows
