"""Status of announced files as events: jobs that run side by side add to it, none replaces what another one wrote."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.rowcounts import apply_status, matched_files
from daybook.sources.lake import data_file, empty_frame

EVENT_COLUMNS = "FILE_NAME string, HDFS_ROW_COUNT bigint, DATA_LAKE_COUNT bigint, DATA_LAKE_STATUS string, JOB string, EVENT_AT timestamp"


def append_status(status: DataFrame, path: str, day: dt.date, job: str) -> None:
    """Add the counts and status of the matched files of one job (``rowcounts.row_count_status``) to the events of a date.

    Each call writes a folder of its own, so no two writers share a staging folder, and a call that fails leaves none.
    """
    events = matched_files(status).select(
        "FILE_NAME", "HDFS_ROW_COUNT", "DATA_LAKE_COUNT", "DATA_LAKE_STATUS", F.lit(job).alias("JOB"), F.current_timestamp().alias("EVENT_AT")
    )
    events.write.parquet(f"{path}/EVENT_DAY={day}/entry={uuid.uuid4().hex}")


def status_events(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """All events of a date; none when nothing was ever added."""
    folder = f"{path}/EVENT_DAY={day}"
    if data_file(spark, folder) is None:
        return empty_frame(spark, f"{EVENT_COLUMNS}, entry string")
    return spark.read.schema(f"{EVENT_COLUMNS}, entry string").parquet(folder)


def latest_events(events: DataFrame) -> DataFrame:
    """The latest event of each announced count of a file; between equal times the name of the folder decides."""
    values = F.struct("DATA_LAKE_COUNT", "DATA_LAKE_STATUS", "JOB")
    latest = events.groupBy("FILE_NAME", "HDFS_ROW_COUNT").agg(F.max_by(values, F.struct("EVENT_AT", "entry")).alias("latest"))
    return latest.select("FILE_NAME", "HDFS_ROW_COUNT", "latest.*")


def current_control(control: DataFrame, path: str, day: dt.date) -> DataFrame:
    """Control rows of a date with what the events say about them so far."""
    return apply_status(control, latest_events(status_events(control.sparkSession, path, day)))
