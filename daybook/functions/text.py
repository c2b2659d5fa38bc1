"""Clean-up of codes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.amounts import as_column

# File names are <prefix><8-digit date>_<stream letter>...
# The strict form wants an underscore after the letter, the loose form does not.
STRICT_FILE_PATTERN = r"^(.*?)(\d{8})_([a-zA-Z])_.*$"
LOOSE_FILE_PATTERN = r"^(.*?)(\d{8})_([a-zA-Z]).*$"
FILE_NAME_PARTS = {"prefix": 1, "date": 2, "stream": 3}


def strip_zeros(code: Column | str) -> Column:
    """Remove leading zeros; an all-zero code becomes empty."""
    return F.ltrim(as_column(code), F.lit("0"))


def tail(code: Column | str, n: int) -> Column:
    """Last ``n`` characters, or the whole code when it is shorter."""
    return F.substring(as_column(code), -n, n)


def file_name_part(name: Column | str, part: str, pattern: str = LOOSE_FILE_PATTERN) -> Column:
    """``prefix``, ``date`` or ``stream`` of a file name; NULL when the name does not fit the pattern."""
    c = as_column(name)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, FILE_NAME_PARTS[part]))


def bare_file_name(path: Column | str) -> Column:
    """File name without folders and without ``.gz``."""
    return F.regexp_replace(F.substring_index(as_column(path), "/", -1), r"\.gz$", "")
