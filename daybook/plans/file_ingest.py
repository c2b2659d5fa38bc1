"""Ingest of ledger and account files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions import MONEY, decode_overpunch
from daybook.functions.text import LOOSE_FILE_PATTERN, STRICT_FILE_PATTERN
from daybook.operators import rowcounts
from daybook.operators.parse import (
    JUDGED_COLUMNS,
    REJECTED,
    STORED,
    Field,
    account_rows,
    account_type,
    judged_account_rows,
    ledger_rows,
    parse_fixed_width,
    parse_raw_ledger,
    unsigned_amounts,
)
from daybook.session import checkpointed
from daybook.sinks import lake, reports, steps
from daybook.sinks.control import append_status
from daybook.sources.lake import empty_frame, read_lake, read_slice
from daybook.sources.text_files import (
    control_paths,
    files_below,
    path_list,
    qualified,
    read_lines,
    split_by_presence,
)


@dataclass(frozen=True)
class Ingested:
    """Parsed rows and how their counts compare with the control table.

    Where lines are judged, ``rejects`` are those that were not stored, and ``outcomes`` has for each file how many lines
    were read, stored and rejected.
    """

    rows: DataFrame
    compared: DataFrame
    status: DataFrame
    rejects: DataFrame | None = None
    outcomes: DataFrame | None = None


def ingest_ledger_files(lines: DataFrame, control: DataFrame, layout: Sequence[Field]) -> Ingested:
    """Typed rows of ledger lines (columns value and FILE_NAME), with the row counts of every file."""
    return counted(ledger_rows(lines, layout), control)


def counted(rows: DataFrame, control: DataFrame) -> Ingested:
    actual = rowcounts.file_row_counts(rows)
    return Ingested(
        rows, rowcounts.reconcile_row_counts(control, actual), rowcounts.row_count_status(control, actual)
    )


class NothingToIngest(LookupError):
    """None of the announced files is there; the table was left as it is."""


@dataclass(frozen=True)
class Control:
    """The control table of a day, to be updated with what was read, and where steps are logged.

    With ``events`` the status is added to the events of the day and the table itself stays as it is, which jobs that run
    side by side need; else the rows of the day are replaced.
    """

    path: str
    column: str
    day: dt.date
    step_log: str | None = None
    run_id: str = ""
    events: str | None = None


def run_ledger_ingest(
    spark: SparkSession,
    control: DataFrame,
    input_folder: str,
    layout: Sequence[Field],
    table: str,
    report_folder: str,
    pattern: str = LOOSE_FILE_PATTERN,
    lower_stream: bool = False,
    partitions: int | None = None,
    update: Control | None = None,
    parse: Callable[[DataFrame, Sequence[Field]], DataFrame] = ledger_rows,
) -> Ingested:
    """Scan the files that the control table announces, write the table, report on it and update the control table.

    The compressed text is read once and spread over ``partitions`` tasks, by default as many as a shuffle has. Row
    counts come from the FILE_NAME column of the table that was written and are held, one row per file. When none of
    the files is there, the report names them, the table is left as it is and :class:`NothingToIngest` is raised.
    ``parse`` chooses the variant of the rows. With ``parse.judged_ledger_rows`` one write puts stored and rejected lines
    into two parts of the table, and lines read are lines stored plus lines rejected, file by file. With ``update`` the
    control rows of its date get counts and status, and the steps are logged, also one that fails.
    """
    with logged(spark, update, "ingest"):
        return _ledger_ingest(
            spark, control, input_folder, layout, table, report_folder, pattern, lower_stream, partitions, update, parse
        )


def _ledger_ingest(
    spark: SparkSession,
    control: DataFrame,
    input_folder: str,
    layout: Sequence[Field],
    table: str,
    report_folder: str,
    pattern: str,
    lower_stream: bool,
    partitions: int | None,
    update: Control | None,
    parse: Callable[[DataFrame, Sequence[Field]], DataFrame],
) -> Ingested:
    base = qualified(spark, input_folder)
    expected = control_paths(control, base, pattern, lower_stream)
    found, missing = split_by_presence(checkpointed(expected), files_below(spark, base))
    missing = checkpointed(missing)
    paths = path_list(found)
    if not paths:
        _report_nothing(control, missing, report_folder)
        raise NothingToIngest(f"none of the announced files is below {base}; {table} was left as it is")
    lines = read_lines(spark, paths, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    parsed = parse(lines, layout)
    if "OUTCOME" in parsed.columns:
        lake.overwrite_parts(parsed, table, ["OUTCOME"])
        return _finished(spark, *judged_parts(spark, table, parsed.schema), control, missing, report_folder, update)
    lake.overwrite(parsed, table)
    rows = read_lake(spark, table)
    return _finished(spark, rows, None, None, control, missing, report_folder, update)


def judged_parts(spark: SparkSession, table: str, schema: StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows, rejected lines, and the lines read, stored and rejected of each file (and type), held."""
    everything = spark.read.schema(schema).parquet(table)
    keys = [name for name in ("FILE_TYPE", "FILE_NAME") if name in everything.columns]
    outcomes = checkpointed(
        everything.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("ROWS_READ"),
            F.count_if(F.col("OUTCOME") == STORED).alias("ROWS_STORED"),
            F.count_if(F.col("OUTCOME") == REJECTED).alias("ROWS_REJECTED"),
        )
    )
    stored = everything.filter(F.col("OUTCOME") == STORED).drop(*JUDGED_COLUMNS)
    rejects = everything.filter(F.col("OUTCOME") == REJECTED).select(*keys, "REASON", "RAW_LINE")
    return stored, rejects, outcomes


def _report_nothing(control: DataFrame, missing: DataFrame, report_folder: str) -> None:
    none = rowcounts.row_count_status(control.limit(0), empty_frame(control.sparkSession, "FILE_NAME string, ROW_COUNT bigint"))
    name = reports.discrepancy_name(missing.count(), 0, 0)
    reports.write_text(rowcounts.discrepancy_report(missing, none), f"{report_folder}/{name}")


def _finished(
    spark: SparkSession,
    rows: DataFrame,
    rejects: DataFrame | None,
    outcomes: DataFrame | None,
    control: DataFrame,
    missing: DataFrame,
    report_folder: str,
    update: Control | None,
) -> Ingested:
    """Reports and control rows of what was written."""
    if outcomes is None:
        actual = checkpointed(rowcounts.file_row_counts(rows))
    else:
        actual = outcomes.select("FILE_NAME", F.col("ROWS_READ").alias("ROW_COUNT"))
    result = Ingested(
        rows, rowcounts.reconcile_row_counts(control, actual), rowcounts.row_count_status(control, actual), rejects, outcomes
    )
    report = checkpointed(rowcounts.discrepancy_report(missing, result.status))
    sizes = {row["SECTION"]: row["count"] for row in report.groupBy("SECTION").count().collect()}
    total = rowcounts.total_rows(actual).first()["ROWS_READ"]
    name = reports.discrepancy_name(sizes.get(1, 0), sizes.get(2, 0), total)
    reports.write_text(report, f"{report_folder}/{name}", order=("SECTION", "REPORT_LINE"))
    reports.write_text(rowcounts.row_count_report(result.compared), f"{report_folder}/row_counts")
    if update is not None and update.events is not None:
        append_status(result.status, update.events, update.day, update.run_id)
    elif update is not None:
        announced = read_slice(spark, update.path, update.column, update.day)
        filled = rowcounts.apply_status(announced, result.status)
        lake.update_control_status(update.path, filled, update.column, update.day)
    return result


def logged(spark: SparkSession, update: Control | None, step: str) -> AbstractContextManager:
    return steps.logged_step(spark, update.step_log if update else None, update.run_id if update else "", step)


def entry_rows(lines: DataFrame, layout: Sequence[Field], file_name: str = "FILE_NAME") -> DataFrame:
    """Variant of the ingest for raw entry lines at their known positions.

    Both the amount as it stands in the file, ``Amount_raw``, and its value, ``Amount_final``, are kept.
    """
    raw = parse_raw_ledger(lines, keep=[file_name])
    amount = decode_overpunch("AMOUNT_RAW").cast(MONEY)
    return raw.select(file_name, "CURRENCY_IND", "GLCC", F.col("AMOUNT_RAW").alias("Amount_raw"), amount.alias("Amount_final"))


def unsigned_rows(lines: DataFrame, layout: Sequence[Field], file_name: str = "FILE_NAME") -> DataFrame:
    """Variant of the ingest that keeps the columns of the layout as text, amounts as digits without a sign."""
    return unsigned_amounts(parse_fixed_width(lines, layout, keep=[file_name]), layout)


def run_account_ingest(
    spark: SparkSession,
    control: DataFrame,
    input_folder: str,
    layout: Sequence[Field],
    file_type: str,
    table: str,
    partitions: int | None = None,
) -> bool:
    """Scan the account files of one type and write their table; False when none that is announced is there.

    The types are independent jobs: run them side by side by whatever starts the jobs.
    """
    announced = control.filter(F.startswith(F.col("FILE_NAME"), F.lit(file_type)))
    base = qualified(spark, input_folder)
    expected = control_paths(announced, base, STRICT_FILE_PATTERN)
    paths = path_list(split_by_presence(expected, files_below(spark, base))[0])
    if not paths:
        return False
    lines = read_lines(spark, paths, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    lake.overwrite(account_rows(lines, layout, file_type), table)
    return True


def run_account_files(
    spark: SparkSession,
    control: DataFrame,
    input_folder: str,
    layouts: Mapping[str, Sequence[Field]],
    table: str,
    report_folder: str,
    pattern: str = STRICT_FILE_PATTERN,
    partitions: int | None = None,
    update: Control | None = None,
) -> Ingested:
    """Scan the announced account files of all types at once and write one table, divided by type and outcome.

    A type is the name that a file name begins with; announced files of other types are none of this job's. All files
    are read in one scan, each line is cut by the layout of its type, and the write puts every type, stored and rejected
    lines apart. Reports, counts and control rows cover all types, a type without a file included. When no file is there
    at all, the report names them, the table is left as it is and :class:`NothingToIngest` is raised.
    """
    with logged(spark, update, "account_ingest"):
        announced = control.filter(account_type("FILE_NAME", layouts).isNotNull())
        base = qualified(spark, input_folder)
        found, missing = split_by_presence(checkpointed(control_paths(announced, base, pattern)), files_below(spark, base))
        missing = checkpointed(missing)
        paths = path_list(found)
        if not paths:
            _report_nothing(announced, missing, report_folder)
            raise NothingToIngest(f"none of the announced files is below {base}; {table} was left as it is")
        lines = read_lines(spark, paths, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows = judged_account_rows(lines.withColumn("FILE_TYPE", account_type("FILE_NAME", layouts)), layouts)
        lake.overwrite_parts(rows, table, ["FILE_TYPE", "OUTCOME"])
        return _finished(spark, *judged_parts(spark, table, rows.schema), announced, missing, report_folder, update)


def type_presence(control: DataFrame, outcomes: DataFrame, types: Sequence[str]) -> DataFrame:
    """FILE_TYPE, ANNOUNCED, FOUND: announced and read files of every type, zeros included."""
    names = control.select(account_type("FILE_NAME", types).alias("FILE_TYPE"), "FILE_NAME").filter("FILE_TYPE IS NOT NULL").distinct()
    read = outcomes.select("FILE_NAME", F.lit(1).alias("_read"))
    counted = names.join(read, "FILE_NAME", "left").groupBy("FILE_TYPE").agg(
        F.count(F.lit(1)).alias("ANNOUNCED"), F.count("_read").alias("FOUND")
    )
    every = control.sparkSession.createDataFrame([(t,) for t in types], "FILE_TYPE string")
    return every.join(counted, "FILE_TYPE", "left").na.fill(0, ["ANNOUNCED", "FOUND"])


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """Dates of a catch-up run, both ends included."""
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
