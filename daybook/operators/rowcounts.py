"""Expected against actual row counts of files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
ALL_MATCHED_LINE = "SUCCESS : ALL FILES ROW COUNT MATCHED"
MATCHED_STATUS = "YES"


def file_row_counts(lines: DataFrame, file_name: str = "FILE_NAME") -> DataFrame:
    """Rows per file."""
    return lines.groupBy(file_name).agg(F.count(F.lit(1)).alias("ROW_COUNT"))


def total_rows(counts: DataFrame) -> DataFrame:
    """Rows of all files together, out of the counts per file."""
    return counts.agg(F.coalesce(F.sum("ROW_COUNT"), F.lit(0)).alias("ROWS_READ"))


def compare_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every file of either side with both counts."""
    return expected.select("FILE_NAME", F.col("HDFS_ROW_COUNT").cast("bigint").alias("HDFS_ROW_COUNT")).join(
        actual.select("FILE_NAME", "ROW_COUNT"), "FILE_NAME", "full_outer"
    )


def reconcile_row_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both counts and their difference for every file."""
    return compare_counts(expected, actual).withColumn("DIFFERENCE", F.col("ROW_COUNT") - F.col("HDFS_ROW_COUNT"))


def count_mismatches(compared: DataFrame) -> DataFrame:
    """Files that one side lacks or whose counts differ."""
    return compared.filter(~F.coalesce(F.col("HDFS_ROW_COUNT") == F.col("ROW_COUNT"), F.lit(False)))


def row_count_status(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both counts with status YES where they agree and NULL elsewhere."""
    compared = compare_counts(expected, actual).withColumnRenamed("ROW_COUNT", "DATA_LAKE_COUNT")
    agree = F.col("HDFS_ROW_COUNT") == F.col("DATA_LAKE_COUNT")
    return compared.withColumn("DATA_LAKE_STATUS", F.when(agree, MATCHED_STATUS))


def matched_files(status: DataFrame) -> DataFrame:
    return status.filter(F.col("DATA_LAKE_COUNT").isNotNull() & F.col("DATA_LAKE_STATUS").isNotNull())


def unmatched_files(status: DataFrame) -> DataFrame:
    return status.filter(F.col("DATA_LAKE_COUNT").isNull() | F.col("DATA_LAKE_STATUS").isNull())


def _shown(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit("NULL"))


def row_count_report(compared: DataFrame) -> DataFrame:
    """One line per mismatched file, or a single success line when there is none."""
    mismatches = count_mismatches(compared)
    line = F.concat(
        F.lit("FILE_NAME="),
        _shown("FILE_NAME"),
        F.lit(" | CONTROL_COUNT="),
        _shown("HDFS_ROW_COUNT"),
        F.lit(" | ACTUAL_COUNT="),
        _shown("ROW_COUNT"),
        F.lit(" | DIFFERENCE="),
        _shown("DIFFERENCE"),
    )
    success = (
        mismatches.agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == 0)
        .select(F.lit(ALL_MATCHED_LINE).alias("REPORT_LINE"))
    )
    return mismatches.select(line.alias("REPORT_LINE")).unionByName(success)


def discrepancy_report(missing: DataFrame, status: DataFrame) -> DataFrame:
    """Lines of the discrepancy report: missing paths, then every unmatched file with both counts."""
    paths = missing.select(F.lit(1).alias("SECTION"), F.concat(F.lit("MISSING "), "PATH").alias("REPORT_LINE"))
    counts = F.concat_ws(
        " | ", _shown("FILE_NAME"), _shown("HDFS_ROW_COUNT"), _shown("DATA_LAKE_COUNT"), _shown("DATA_LAKE_STATUS")
    )
    files = unmatched_files(status).select(F.lit(2).alias("SECTION"), counts.alias("REPORT_LINE"))
    return paths.unionByName(files)


def apply_status(control: DataFrame, status: DataFrame) -> DataFrame:
    """Control table with the counts and status of its matched files filled in; other rows stay as they are.

    A file that the control table names twice gets no further rows: each control row takes the status of its own count.
    """
    found = matched_files(status).groupBy("FILE_NAME", F.col("HDFS_ROW_COUNT").alias("_EXPECTED")).agg(
        F.max("DATA_LAKE_COUNT").alias("_COUNT"), F.max("DATA_LAKE_STATUS").alias("_STATUS")
    )
    same = (control["FILE_NAME"] == found["FILE_NAME"]) & (control["HDFS_ROW_COUNT"] == found["_EXPECTED"])
    updated = control.join(found, same, "left").drop(found["FILE_NAME"]).withColumns(
        {
            "DATA_LAKE_COUNT": F.coalesce(F.col("_COUNT"), F.col("DATA_LAKE_COUNT")),
            "DATA_LAKE_STATUS": F.coalesce(F.col("_STATUS"), F.col("DATA_LAKE_STATUS")),
        }
    )
    return updated.select(*control.columns)
