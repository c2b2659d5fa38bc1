"""Profit and loss transfer."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from daybook.operators import transfers as tr
from daybook.session import broadcast_if_small, checkpointed
from daybook.sinks import lake, steps


@dataclass(frozen=True)
class TransferResult:
    postings: DataFrame
    balances: DataFrame
    report: DataFrame


def pl_transfer(
    balances: DataFrame,
    branches: DataFrame,
    circles: DataFrame,
    day: dt.date,
    batch_id: int | str | None = None,
    journal_id: int | str | None = None,
    hold=lambda df: df,
) -> TransferResult:
    """Income and expense balances (GLCC, BALANCE) to transfer postings, new balances and the report per branch."""
    profit = hold(tr.assigned_profit(tr.branch_totals(balances), branches, circles))
    postings = tr.transfer_postings(tr.of_kind(profit, tr.ORDINARY), day, batch_id, journal_id)
    moved = hold(tr.balances_after(profit, day))
    return TransferResult(postings, moved, tr.transfer_report(moved, tr.branch_circles(branches, circles)))


def run_pl_transfer(
    balances: DataFrame,
    branches: DataFrame,
    circles: DataFrame,
    day: dt.date,
    folder: str,
    batch_id: int | str | None = None,
    journal_id: int | str | None = None,
    step_log: str | None = None,
) -> TransferResult:
    """Write the three tables of the transfer; each gets the date replaced, so a rerun ends in the same state.

    A step that fails is logged as failed.
    """
    with steps.logged_step(balances.sparkSession, step_log, str(batch_id or ""), "pl_transfer"):
        small = broadcast_if_small(branches, circles)
        result = pl_transfer(balances, *small, day, batch_id, journal_id, hold=checkpointed)
        lake.replace_slice(result.postings, f"{folder}/transactions", "TRANSACTION_DATE", day)
        lake.replace_slice(result.balances, f"{folder}/balances", "BALANCE_DATE", day)
        lake.replace_slice(result.report, f"{folder}/report", "TRANSFER_DATE", day)
        return result
