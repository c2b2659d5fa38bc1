"""Transfer of branch profit and loss to the circle branches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import MONEY, compose_glcc, split_glcc
from daybook.operators.lookups import keep_unknown

# Fixed values.
PROFIT_CGL = "2110505001"
TRANSFER_CGL = "1106505001"
TRANSFER_CURRENCY = "INR"
TRANSFER_FLAG = "T"
TRANSFER_NARRATION = "P and L Transfer - "
INCOME_EXPENSE_PREFIXES = ("7", "8")
# (branch that posts, account, sign of the branch balance in the posting)
TRANSFER_LEGS = (
    ("BRANCH_CODE", PROFIT_CGL, -1),
    ("BRANCH_CODE", TRANSFER_CGL, 1),
    ("CIRCLE_CODE", TRANSFER_CGL, -1),
    ("CIRCLE_CODE", PROFIT_CGL, 1),
)
ORDINARY, CIRCLE = "ordinary", "circle"
TRANSFER_COLUMNS = (
    "CIRCLE_CODE",
    "BATCH_ID",
    "TRANSACTION_COUNT",
    "BRANCH_CODE",
    "CURRENCY",
    "CGL",
    "DEBIT_AMOUNT",
    "CREDIT_AMOUNT",
    "TRANSACTION_DATE",
    "SOURCE_FLAG",
    "JOURNAL_ID",
    "NARRATION",
)


def is_income_expense() -> Column:
    """Whether CGL is an income or expense account; written as prefixes, which Spark pushes into the parquet scan."""
    income, expense = (F.startswith(F.col("CGL"), F.lit(prefix)) for prefix in INCOME_EXPENSE_PREFIXES)
    return income | expense


def latest_date(balances: DataFrame) -> Column:
    """The latest date of a frame, as a scalar subquery over the date column alone."""
    return balances.agg(F.max("BALANCE_DATE")).scalar()


def latest_income_expense(balances: DataFrame, latest: dt.date | None = None) -> DataFrame:
    """Income and expense balances of the latest date, in the home currency.

    Of a lake table pass the ``latest`` date that its partition folders tell (``latest_partition``): the other dates
    are then pruned and no file of theirs is opened. Without it the date column is read first.
    """
    latest = latest_date(balances) if latest is None else F.lit(latest)
    rows = balances.filter(F.col("BALANCE_DATE") == latest)
    return rows.filter(is_income_expense()).select(
        compose_glcc().alias("GLCC"),
        F.col("INR_BALANCE").cast(MONEY).alias("BALANCE"),
        "BALANCE_DATE",
    )


def branch_circles(branches: DataFrame, circles: DataFrame) -> DataFrame:
    """Every branch with the branch of its circle, NULL where the circle has none."""
    owner = circles.select("CIRCLE_CODE", F.col("BRANCH_CODE").alias("CIRCLE_BRANCH"))
    return branches.join(owner, "CIRCLE_CODE", "left").select(
        F.col("CODE").alias("BRANCH_CODE"), F.col("CIRCLE_BRANCH").alias("CIRCLE_CODE")
    )


def circle_assignment(branches: DataFrame, circles: DataFrame) -> DataFrame:
    """Ordinary branches with the branch of their circle; branches that are circle branches are left out."""
    own = circles.select(F.col("BRANCH_CODE").alias("_CIRCLE_BRANCH"))
    ordinary = keep_unknown(branches, own, branches["CODE"] == own["_CIRCLE_BRANCH"])
    return branch_circles(ordinary, circles)


def branch_totals(balances: DataFrame) -> DataFrame:
    """Profit or loss per branch. From here on there is one row per branch, whatever the number of balances."""
    keyed = balances.select(split_glcc("GLCC")["BRANCH_CODE"].alias("BRANCH_CODE"), "BALANCE")
    return keyed.groupBy("BRANCH_CODE").agg(F.sum("BALANCE").cast(MONEY).alias("BALANCE"))


def branch_profit(totals: DataFrame, assignment: DataFrame) -> DataFrame:
    """Profit or loss of the branches that have a circle."""
    assigned = totals.join(assignment.filter(F.col("CIRCLE_CODE").isNotNull()), "BRANCH_CODE")
    return assigned.select("BRANCH_CODE", "CIRCLE_CODE", "BALANCE")


def assigned_profit(totals: DataFrame, branches: DataFrame, circles: DataFrame) -> DataFrame:
    """Profit or loss with circle and KIND, ordinary or circle branch, out of one join of the totals."""
    ordinary = circle_assignment(branches, circles).select("BRANCH_CODE", "CIRCLE_CODE", F.lit(ORDINARY).alias("KIND"))
    own = circles.select("BRANCH_CODE", F.col("CIRCLE_CODE").cast("string"), F.lit(CIRCLE).alias("KIND"))
    both = ordinary.unionByName(own).filter(F.col("CIRCLE_CODE").isNotNull())
    return totals.join(both, "BRANCH_CODE").select("BRANCH_CODE", "CIRCLE_CODE", "KIND", "BALANCE")


def of_kind(profit: DataFrame, kind: str) -> DataFrame:
    return profit.filter(F.col("KIND") == kind).drop("KIND")


def balances_after(profit: DataFrame, day: dt.date) -> DataFrame:
    """Balances after the transfer of an assigned profit."""
    postings = transfer_postings(of_kind(profit, ORDINARY), day)
    return transfer_balances(postings, of_kind(profit, CIRCLE), day)


def transfer_postings(
    profit: DataFrame, day: dt.date, batch_id: int | str | None = None, journal_id: int | str | None = None
) -> DataFrame:
    """Four postings per branch that move its profit or loss to the circle branch; a narrow explode, no shuffle."""
    legs = []
    for branch, cgl, sign in TRANSFER_LEGS:
        amount = (F.col("BALANCE") if sign > 0 else -F.col("BALANCE")).cast(MONEY)
        zero = F.lit(0).cast(MONEY)
        legs.append(
            F.struct(
                F.col(branch).cast("string").alias("BRANCH_CODE"),
                F.lit(cgl).alias("CGL"),
                F.greatest(amount, zero).alias("DEBIT_AMOUNT"),
                F.least(amount, zero).alias("CREDIT_AMOUNT"),
            )
        )
    exploded = profit.select("CIRCLE_CODE", F.inline(F.array(*legs)))
    return exploded.withColumns(
        {
            "BATCH_ID": F.lit(batch_id).cast("string"),
            "JOURNAL_ID": F.lit(journal_id).cast("string"),
            "TRANSACTION_COUNT": F.lit(1).cast("bigint"),
            "CURRENCY": F.lit(TRANSFER_CURRENCY),
            "TRANSACTION_DATE": F.lit(day),
            "SOURCE_FLAG": F.lit(TRANSFER_FLAG),
            "NARRATION": F.concat(F.lit(TRANSFER_NARRATION), F.col("CIRCLE_CODE").cast("string")),
        }
    ).select(*TRANSFER_COLUMNS)


def transfer_balances(postings: DataFrame, circle_profit: DataFrame, day: dt.date) -> DataFrame:
    """Balances after the transfer: the postings together with the circle branches' own profit or loss."""
    moved = postings.select("CGL", "BRANCH_CODE", (F.col("DEBIT_AMOUNT") + F.col("CREDIT_AMOUNT")).alias("BALANCE"))
    own = circle_profit.select(F.lit(PROFIT_CGL).alias("CGL"), "BRANCH_CODE", "BALANCE")
    balances = moved.unionByName(own).groupBy("CGL", "BRANCH_CODE").agg(F.sum("BALANCE").cast(MONEY).alias("BALANCE"))
    return balances.select(
        "CGL",
        "BRANCH_CODE",
        F.lit(TRANSFER_CURRENCY).alias("CURRENCY"),
        "BALANCE",
        F.lit(day).alias("BALANCE_DATE"),
        F.col("BALANCE").alias("INR_BALANCE"),
    )


def transfer_report(balances: DataFrame, assignment: DataFrame) -> DataFrame:
    """Profit or loss per branch after the transfer, with the branch of its circle."""
    profit = balances.filter(F.col("CGL") == PROFIT_CGL)
    return profit.join(assignment, "BRANCH_CODE", "left").select(
        F.col("BALANCE_DATE").alias("TRANSFER_DATE"),
        F.col("BALANCE").alias("PROFIT_LOSS"),
        F.col("CIRCLE_CODE").alias("CIRCLE_BRANCH_CODE"),
        "BRANCH_CODE",
    )
