"""Ledger balance of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import is_month_end
from daybook.operators import balances as bal
from daybook.operators import movements as mov
from daybook.operators import postings as post
from daybook.operators.parse import rejected_lines
from daybook.operators.validation import validate
from daybook.session import checkpointed
from daybook.sinks import lake, reports, steps
from daybook.sources.lake import EMPTY_OPENING, empty_frame, find_slice, first_available, present_slice
from daybook.sources.masters import Masters

Rule = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class LedgerDay:
    """What a day is run with. The rules bring extra posting rows from the caller; without a rule there are none."""

    day: dt.date
    run_no: int = 1
    batch_id: str | None = None
    journal_id: str | None = None
    positive_side: str = "CREDIT"
    provision: DataFrame | None = None
    posting_rule: Rule | None = None
    journals: DataFrame | None = None
    month_end_rule: Rule | None = None


@dataclass(frozen=True)
class LedgerResult:
    transactions: DataFrame
    invalid: DataFrame
    balances: DataFrame
    lake_balances: DataFrame
    month_end: DataFrame | None
    rejects: DataFrame
    totals: DataFrame


def ledger_balance(
    lines: DataFrame, masters: Masters, opening: DataFrame, run: LedgerDay, hold: Rule = as_is
) -> LedgerResult:
    """Decoded lines (BRANCH_CODE, CURRENCY, CGL, AMT) to transactions, quarantine, rejects and balances.

    Lines without an amount that counts are rejects and take no part; they are counted in the same pass that sums the
    others, and listed by a scan of their own. ``hold`` is applied to the frames that several results share: the totals
    per key, which stand for the only scan of the lines that count, the balanced postings and the closing balances. Pass ``daybook.session.checkpointed`` when more than one result is
    written; with the default the results are plain lazy plans.
    """
    totals = hold(mov.line_totals(lines, positive_side=run.positive_side))
    postings = mov.as_postings(mov.accepted(totals), run.batch_id)
    if run.provision is not None:
        postings = post.union_postings(postings, run.provision)

    valid, invalid = validate(postings, masters.branches, masters.currencies, masters.cgls, run.day)
    posted = hold(post.balanced_postings(valid))
    if run.posting_rule is not None:
        posted = post.union_postings(posted, post.stamp_postings(run.posting_rule(posted), run.journal_id))

    # Journals count towards the balances only. Balances are summed per key next, so they need no consolidation here.
    moved = posted if run.journals is None else post.union_postings(posted, run.journals)
    closing = bal.carry_forward(bal.movement_balances(moved), opening, run.day)

    month_end = None
    if run.month_end_rule is not None and is_month_end(run.day):
        closing = hold(closing)
        month_end = post.stamp_postings(run.month_end_rule(closing), run.journal_id, run.batch_id)
    closing = bal.apply_month_end(closing, month_end, run.day)

    converted = hold(bal.convert_currency(closing, masters.rates))
    return LedgerResult(
        post.dated(posted, run.day), invalid, converted, bal.lake_balances(converted), month_end, rejected_lines(lines), totals
    )


@dataclass(frozen=True)
class LedgerTables:
    """Paths of the tables that a run writes; all are partitioned by their date column."""

    transactions: str
    invalid: str
    balances: str
    lake_balances: str
    rejects: str
    markers: str
    step_log: str | None = None


def run_ledger_day(
    spark: SparkSession, lines: DataFrame, masters: Masters, opening: DataFrame, run: LedgerDay, tables: LedgerTables
) -> LedgerResult:
    """Write the day. Every table gets its date replaced, so a rerun ends in the same state; the marker comes last.

    Journals and reversals that the transaction table already has for the date stay. Rejected lines are looked for only
    when the totals have counted one. A run that fails is logged as failed.
    """
    with steps.logged_step(spark, tables.step_log, run.batch_id or "", "ledger_day"):
        return _ledger_day(spark, lines, masters, opening, run, tables)


def _ledger_day(
    spark: SparkSession, lines: DataFrame, masters: Masters, opening: DataFrame, run: LedgerDay, tables: LedgerTables
) -> LedgerResult:
    result = ledger_balance(lines, masters, opening, run, hold=checkpointed)
    rejects = result.rejects if mov.has_rejects(result.totals) else empty_frame(spark, result.rejects.schema)
    lake.replace_slice(rejects.withColumn("REJECT_DATE", F.lit(run.day)), tables.rejects, "REJECT_DATE", run.day)
    posted = result.transactions
    if result.month_end is not None:
        posted = posted.unionByName(post.dated(result.month_end, run.day).select(*posted.columns))
    _replace_transactions(spark, posted, tables.transactions, run.day)
    lake.replace_slice(result.invalid, tables.invalid, "TRANSACTION_DATE", run.day)
    lake.replace_slice(result.balances, tables.balances, "BALANCE_DATE", run.day)
    lake.replace_slice(result.lake_balances, tables.lake_balances, "BALANCE_DATE", run.day)
    reports.write_marker(spark, tables.markers, run.day, run.run_no)
    return result


def load_opening(
    spark: SparkSession,
    day: dt.date,
    run_no: int,
    lake_path: str,
    balances: Callable[[], DataFrame],
    year_end: Callable[[], DataFrame],
    allow_empty: bool = False,
) -> tuple[DataFrame, str]:
    """Opening balances and where they came from: the lake slice of the run, else the balance table.

    The financial year starts from the year-end table, which has no substitute. ``balances`` and ``year_end`` load
    tables of the database. Without any source the day must not start, unless ``allow_empty`` says that it is the first.
    """
    source, of = bal.opening_source(day, run_no)
    if source == "year_end":
        return bal.table_opening(year_end(), of), source

    def lake_slice() -> DataFrame | None:
        rows = present_slice(spark, lake_path, "BALANCE_DATE", of)
        return None if rows is None else bal.lake_opening(rows, of)

    loaders = [("lake", lake_slice), ("table", lambda: bal.table_opening(balances(), of))]
    return first_available(spark, loaders, EMPTY_OPENING if allow_empty else None)


def _replace_transactions(spark: SparkSession, posted: DataFrame, path: str, day: dt.date) -> None:
    present = find_slice(spark, path, "TRANSACTION_DATE", day)
    if present is not None:
        posted = lake.purged(present, day).select(*posted.columns).unionByName(posted)
    lake.replace_slice(posted, path, "TRANSACTION_DATE", day)
