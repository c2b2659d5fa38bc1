"""Text and CSV reports, marker files.

A report in one file takes its rows through one task at the end, after the work before it ran in parallel; the row-count
reports have at most one row per file. Pass ``files=None`` for reports that grow with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _spread(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.repartition(files)


def write_text(
    lines: DataFrame, path: str, column: str = "REPORT_LINE", files: int | None = 1, order: Sequence[str] = ()
) -> None:
    """Report lines as text, each file sorted by ``order``."""
    spread = _spread(lines, files)
    ordered = spread.sortWithinPartitions(*order) if order else spread
    ordered.select(column).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, separator: str = "|", files: int | None = None) -> None:
    """Report rows as delimited text with a header."""
    _spread(df, files).write.mode("overwrite").csv(path, sep=separator, header=True)


def discrepancy_name(missing: int, unmatched: int, rows: int) -> str:
    """Name of the discrepancy report, which tells its counts."""
    return f"MissingPath_{missing}_RowDiffCount_{unmatched}_TotalRows_{rows}.txt"


def marker_name(run_no: int) -> str:
    return f"Gl_balance_successful_{run_no}_Manifest.txt"


def write_marker(spark: SparkSession, folder: str, day: dt.date, run_no: int) -> str:
    """Marker of a finished run; to be written after every other sink."""
    path = f"{folder}/{day:%Y%m%d}/{marker_name(run_no)}"
    write_text(spark.createDataFrame([("GL_balance successful",)], "REPORT_LINE string"), path)
    return path
