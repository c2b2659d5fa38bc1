"""Consolidation, balancing and union of postings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import MONEY
from daybook.operators.movements import POSTING_COLUMNS
from daybook.operators.validation import MEMO_CGL, MEMO_PREFIX, SUSPENSE_CGL

# Fixed values.
BALANCING_NARRATION = "OUT OF BAL"
CARRIED_FLAGS = ("J", "R")


def _sums() -> list[Column]:
    """Sums of a group, money in its stored type."""
    amounts = [F.sum(c).cast(MONEY).alias(c) for c in ("CREDIT_AMOUNT", "DEBIT_AMOUNT")]
    return [*amounts, F.sum("TRANSACTION_COUNT").alias("TRANSACTION_COUNT")]


def _texts() -> list[Column]:
    """Descriptive columns of a group: the smallest value, which does not depend on row order."""
    return [F.min(c).alias(c) for c in ("NARRATION", "BATCH_ID", "JOURNAL_ID")]


def bucket() -> Column:
    """Memo accounts balance among themselves, all other accounts among themselves."""
    return F.when(F.startswith(F.col("CGL"), F.lit(MEMO_PREFIX)), MEMO_CGL).otherwise(SUSPENSE_CGL)


def net() -> Column:
    return (F.col("CREDIT_AMOUNT") + F.col("DEBIT_AMOUNT")).cast(MONEY)


def consolidate(postings: DataFrame) -> DataFrame:
    """One posting per account, currency, branch and source."""
    return (
        postings.groupBy("CGL", "CURRENCY", "BRANCH_CODE", "SOURCE_FLAG")
        .agg(*_sums(), *_texts())
        .select(*POSTING_COLUMNS)
    )


def bucket_net(postings: DataFrame) -> DataFrame:
    """Totals and net per branch, currency, bucket and source."""
    return (
        postings.groupBy("BRANCH_CODE", "CURRENCY", bucket().alias("CGL"), "SOURCE_FLAG")
        .agg(*_sums(), *_texts())
        .withColumn("NET", net())
    )


def _counter_sides() -> dict[str, Column]:
    """The two sides of the entry that brings NET to zero."""
    zero = F.lit(0).cast(MONEY)
    return {
        "CREDIT_AMOUNT": F.when(F.col("NET") < 0, -F.col("NET")).otherwise(zero),
        "DEBIT_AMOUNT": F.when(F.col("NET") > 0, -F.col("NET")).otherwise(zero),
        "NARRATION": F.lit(BALANCING_NARRATION),
    }


def balancing_entries(postings: DataFrame) -> DataFrame:
    """One counter-entry per bucket that does not net to zero."""
    return (
        bucket_net(postings).filter(F.col("NET") != 0).withColumns(_counter_sides()).select(*POSTING_COLUMNS)
    )


def balanced_postings(postings: DataFrame) -> DataFrame:
    """Consolidated postings together with their balancing entries.

    Equals ``consolidate`` united with ``balancing_entries`` of its result, but both groupings come out of one shuffle:
    the postings are grouped once by account and once by bucket, as two grouping sets.
    """
    outer = [F.col(c) for c in ("BRANCH_CODE", "CURRENCY", "SOURCE_FLAG", "BUCKET")]
    account = F.col("CGL")
    # grouping() is 1 on the bucket rows, also where the account itself is NULL.
    grouped = (
        postings.withColumn("BUCKET", bucket())
        .groupingSets([[*outer, account], outer], *outer, account)
        .agg(*_sums(), *_texts(), F.grouping("CGL").alias("IS_BUCKET"))
        .withColumn("NET", net())
    )
    is_bucket = F.col("IS_BUCKET") == 1
    changes = {name: F.when(is_bucket, side).otherwise(F.col(name)) for name, side in _counter_sides().items()}
    changes["CGL"] = F.when(is_bucket, F.col("BUCKET")).otherwise(account)
    return grouped.filter(~is_bucket | (F.col("NET") != 0)).withColumns(changes).select(*POSTING_COLUMNS)


def stamp_postings(rows: DataFrame, journal_id: str | None, batch_id: str | None = None) -> DataFrame:
    """Give extra posting rows their journal id and, where asked, their batch id."""
    stamps = {"JOURNAL_ID": F.lit(journal_id).cast("string")}
    if batch_id is not None:
        stamps["BATCH_ID"] = F.lit(batch_id).cast("string")
    return rows.withColumns(stamps)


def union_postings(postings: DataFrame, *extras: DataFrame) -> DataFrame:
    """Bag union by column name."""
    for extra in extras:
        postings = postings.unionByName(extra.select(*postings.columns))
    return postings


def dated(postings: DataFrame, day: dt.date) -> DataFrame:
    return postings.withColumn("TRANSACTION_DATE", F.lit(day))


def carried_journals(transactions: DataFrame, day: dt.date) -> DataFrame:
    """Journal and reversal postings that the date already has."""
    of_day = F.col("TRANSACTION_DATE") == F.lit(day)
    return transactions.filter(of_day & F.col("SOURCE_FLAG").isin(*CARRIED_FLAGS)).select(*POSTING_COLUMNS)


def merge_journals(postings: DataFrame, journals: DataFrame) -> DataFrame:
    """Postings united with the journals of the date and consolidated again."""
    return consolidate(union_postings(postings, journals))
