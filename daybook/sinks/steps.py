"""Step log: one row per state of a step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
STARTED, SUCCEEDED, FAILED = 1, 2, 3
STEP_COLUMNS = "RUN_ID string, STEP string, STATUS int, MESSAGE string"


def step_rows(spark: SparkSession, run_id: str, step: str, status: int, message: str = "") -> DataFrame:
    """A log row; its time is that of the write."""
    row = spark.createDataFrame([(run_id, step, status, message)], STEP_COLUMNS)
    return row.withColumns({"PAYLOAD": F.lit(None).cast("string"), "LOGGED_AT": F.current_timestamp()})


def append_states(rows: DataFrame, path: str) -> None:
    """Append states to the log, each call in a folder of its own: jobs that run side by side share no staging folder."""
    rows.write.parquet(f"{path}/entry={uuid.uuid4().hex}")


def log_step(
    spark: SparkSession, path: str, run_id: str, step: str, status: int, message: str = "", payload: str | None = None
) -> None:
    """Append the state of a step, with an optional JSON text such as the difference summary."""
    rows = step_rows(spark, run_id, step, status, message)
    if payload is not None:
        rows = rows.withColumn("PAYLOAD", F.lit(payload))
    append_states(rows.coalesce(1), path)


@dataclass
class StepState:
    """What a step tells when it ends well."""

    message: str = ""
    payload: str | None = None


MOST_MESSAGE = 2000


@contextmanager
def logged_step(spark: SparkSession, path: str | None, run_id: str, step: str) -> Iterator[StepState]:
    """Log a step as started, then as succeeded or, when its body raises, as failed; the error goes on to the caller.

    A failed step has the first line of the error as its message and a JSON text with the kind of the error and its
    full message, up to 2,000 characters, as payload. Without a path nothing is logged.
    """
    state = StepState()

    def log(status: int, message: str, payload: str | None = None) -> None:
        if path is not None:
            log_step(spark, path, run_id, step, status, message, payload)

    log(STARTED, "")
    try:
        yield state
    except BaseException as error:
        text = str(error)
        told = {"step": step, "error": type(error).__name__, "message": text[:MOST_MESSAGE]}
        log(FAILED, f"{type(error).__name__}: {text.splitlines()[0] if text else ''}"[:MOST_MESSAGE], json.dumps(told))
        raise
    log(SUCCEEDED, state.message, state.payload)


def latest_status(steps: DataFrame) -> DataFrame:
    """Latest status of every step; between equal times the higher status counts."""
    order = F.struct("LOGGED_AT", "STATUS")
    return steps.groupBy("RUN_ID", "STEP").agg(F.max_by("STATUS", order).alias("STATUS"))
