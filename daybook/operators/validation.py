"""Validation of postings against the branch, currency and account masters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookups import flag_known
from daybook.operators.movements import POSTING_COLUMNS

# Fixed values.
INVALID_BRANCH = "INVALID BRANCH"
INVALID_CURRENCY = "INVALID CURRENCY"
MEMO_PREFIX = "5"
MEMO_CGL = "5000000000"
SUSPENSE_CGL = "1111111111"
INVALID_CGL_MARK = "- INVALID-"
INVALID_COLUMNS = tuple(c for c in POSTING_COLUMNS if c != "JOURNAL_ID") + ("REASON",)


def _split(checked: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    valid = checked.filter(F.col("REASON").isNull()).select(*columns)
    return valid, checked.filter(F.col("REASON").isNotNull()).select(*INVALID_COLUMNS)


def quarantine_branch(postings: DataFrame, branches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split postings into those of known branches and the rest."""
    flagged = flag_known(postings, branches, "BRANCH_CODE", "KNOWN_BRANCH")
    checked = flagged.withColumn("REASON", F.when(F.col("KNOWN_BRANCH").isNull(), INVALID_BRANCH))
    return _split(checked, postings.columns)


def quarantine_currency(postings: DataFrame, currencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split postings into those of known currencies and the rest."""
    flagged = flag_known(postings, currencies, "CURRENCY", "KNOWN_CURRENCY")
    checked = flagged.withColumn("REASON", F.when(F.col("KNOWN_CURRENCY").isNull(), INVALID_CURRENCY))
    return _split(checked, postings.columns)


def invalid_union(by_branch: DataFrame, by_currency: DataFrame, day: dt.date) -> DataFrame:
    """All quarantined postings, stamped with the posting date."""
    return by_branch.unionByName(by_currency).withColumn("TRANSACTION_DATE", F.lit(day))


def remap_cgl(postings: DataFrame, cgls: DataFrame) -> DataFrame:
    """Move postings of unknown accounts to the memo or the suspense account and note the old one."""
    known = F.col("KNOWN_CGL").isNotNull()
    substitute = F.when(F.startswith(F.col("CGL"), F.lit(MEMO_PREFIX)), MEMO_CGL).otherwise(SUSPENSE_CGL)
    note = F.concat(F.col("NARRATION"), F.lit(INVALID_CGL_MARK), F.col("CGL"))
    return (
        flag_known(postings, cgls, "CGL", "KNOWN_CGL")
        .withColumns(
            {
                "CGL": F.when(known, F.col("CGL")).otherwise(substitute),
                "NARRATION": F.when(known, F.col("NARRATION")).otherwise(note),
            }
        )
        .select(*postings.columns)
    )


def validate(
    postings: DataFrame, branches: DataFrame, currencies: DataFrame, cgls: DataFrame, day: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Valid postings with remapped accounts, and the quarantined ones with their reason.

    The currency is judged only where the branch is known, which the order of the two reasons expresses: both joins sit
    in one pass over the postings, and no posting is joined twice.
    """
    flagged = flag_known(
        flag_known(postings, branches, "BRANCH_CODE", "KNOWN_BRANCH"), currencies, "CURRENCY", "KNOWN_CURRENCY"
    )
    reason = F.when(F.col("KNOWN_BRANCH").isNull(), INVALID_BRANCH).when(
        F.col("KNOWN_CURRENCY").isNull(), INVALID_CURRENCY
    )
    valid, invalid = _split(flagged.withColumn("REASON", reason), postings.columns)
    return remap_cgl(valid, cgls), invalid.withColumn("TRANSACTION_DATE", F.lit(day))
