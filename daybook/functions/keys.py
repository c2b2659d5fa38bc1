"""The 18-character account key: branch (5), currency (3), ledger account (10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.amounts import as_column

# Fixed values: (column, first character, length) of the key parts.
KEY_PARTS = (("BRANCH_CODE", 1, 5), ("CURRENCY", 6, 3), ("CGL", 9, 10))


def compose_glcc() -> Column:
    """Key from the columns BRANCH_CODE, CURRENCY and CGL; NULL when any of them is NULL."""
    return F.concat(*[F.col(name) for name, _, _ in KEY_PARTS])


def split_glcc(key: Column | str) -> dict[str, Column]:
    """The three parts of a key, by column name; use with ``withColumns`` or ``select``."""
    return {name: F.substring(as_column(key), start, length) for name, start, length in KEY_PARTS}
