"""From ledger lines to one posting per account key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import (
    MONEY,
    compose_glcc,
    decode_overpunch,
    effective_amount,
    negative_part,
    positive_part,
    split_glcc,
)
from daybook.functions.amounts import LEDGER_WIDTH

# Fixed values of the postings built here.
EXCLUDED_FILE_PREFIXES = ("glifpri", "glifprb")
POSTING_COLUMNS = (
    "BATCH_ID",
    "JOURNAL_ID",
    "BRANCH_CODE",
    "CURRENCY",
    "CGL",
    "NARRATION",
    "CREDIT_AMOUNT",
    "DEBIT_AMOUNT",
    "TRANSACTION_COUNT",
    "SOURCE_FLAG",
)
LINE_NARRATION = "CBS txns"
LINE_SOURCE_FLAG = "C"
SIDES = {"CREDIT": ("CREDIT_AMOUNT", "DEBIT_AMOUNT"), "DEBIT": ("DEBIT_AMOUNT", "CREDIT_AMOUNT")}


def exclude_file_types(
    lines: DataFrame, file_name: str = "FILE_NAME", prefixes: Sequence[str] = EXCLUDED_FILE_PREFIXES
) -> DataFrame:
    """Drop the lines of some file types; lines without a file name go too."""
    name = F.lower(F.col(file_name))
    for prefix in prefixes:
        lines = lines.filter(~F.startswith(name, F.lit(prefix)))
    return lines


def ledger_amounts(
    lines: DataFrame,
    currency: str = "CURRENCY_IND",
    foreign: str = "FOREIGN_AMOUNT",
    local: str = "AMOUNT",
    amount: str = "AMT",
) -> DataFrame:
    """Choose the amount that counts and decode it. Pass ``currency="CURRENCY"`` for the older rule."""
    return lines.withColumn(amount, decode_overpunch(effective_amount(currency, foreign, local), LEDGER_WIDTH))


def split_signed(lines: DataFrame, amount: str = "AMT", positive_side: str = "CREDIT") -> DataFrame:
    """Add the credit and debit side of a signed amount, in the stored type of money."""
    above, below = SIDES[positive_side]
    return lines.withColumns({above: positive_part(amount).cast(MONEY), below: negative_part(amount).cast(MONEY)})


def line_totals(lines: DataFrame, amount: str = "AMT", positive_side: str = "CREDIT") -> DataFrame:
    """Credit, debit, count of accepted and of rejected lines per key; a line without an amount is rejected.

    One pass over the lines serves both: no filter stands between the decoder and the sums, so an amount is decoded
    once. Lines are summed before the shuffle, so a key that holds a third of the lines costs one row per task. Lines
    whose key has a NULL part form one group and are counted too.
    """
    keyed = split_signed(lines.select(compose_glcc().alias("GLCC"), amount), amount, positive_side)
    return keyed.groupBy("GLCC").agg(
        F.sum("CREDIT_AMOUNT").cast(MONEY).alias("CREDIT_AMOUNT"),
        F.sum("DEBIT_AMOUNT").cast(MONEY).alias("DEBIT_AMOUNT"),
        F.count(amount).alias("TRANSACTION_COUNT"),
        (F.count(F.lit(1)) - F.count(amount)).alias("REJECTED_COUNT"),
    )


def accepted(totals: DataFrame) -> DataFrame:
    """Totals of the keys that have an accepted line."""
    return totals.filter(F.col("TRANSACTION_COUNT") > 0).drop("REJECTED_COUNT")


def has_rejects(totals: DataFrame) -> bool:
    """Whether any line was rejected; on stored totals a look at the statistics of one column."""
    return not totals.filter(F.col("REJECTED_COUNT") > 0).isEmpty()


def key_totals(lines: DataFrame, amount: str = "AMT", positive_side: str = "CREDIT") -> DataFrame:
    """Credit, debit and line count per key; here a line without an amount counts, as nothing on either side."""
    both = F.col("TRANSACTION_COUNT") + F.col("REJECTED_COUNT")
    return line_totals(lines, amount, positive_side).withColumn("TRANSACTION_COUNT", both).drop("REJECTED_COUNT")


def aggregate_movements(
    lines: DataFrame, batch_id: str | None = None, amount: str = "AMT", positive_side: str = "CREDIT"
) -> DataFrame:
    """One posting per account key."""
    return as_postings(key_totals(lines, amount, positive_side), batch_id)


def as_postings(totals: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Give key totals the columns of a posting."""
    constants = {
        "BATCH_ID": F.lit(batch_id).cast("string"),
        "JOURNAL_ID": F.lit(None).cast("string"),
        "NARRATION": F.lit(LINE_NARRATION),
        "SOURCE_FLAG": F.lit(LINE_SOURCE_FLAG),
    }
    return totals.withColumns({**split_glcc("GLCC"), **constants}).select(*POSTING_COLUMNS)
