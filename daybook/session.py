"""Shared working folder of a run, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary folder only for a local master without one."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute a frame once into the shared folder, so that several sinks reuse it and lost executors do no harm.

    It is stored as parquet, so later readers take the columns and rows that they need. The folder is the caller's or
    the cluster's to clear once the run is over.
    """
    folder = new_folder(df.sparkSession, "held")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def measured_bytes(*frames: DataFrame) -> list[int]:
    """Payload size of each frame, measured by one job that returns a single row per frame."""
    sizes = None
    for position, df in enumerate(frames):
        payload = ", ".join(f"`{name}`" for name in df.columns)
        row_bytes = f"{ROW_OVERHEAD_BYTES} + octet_length(concat_ws('', {payload}))"
        size = df.selectExpr(f"{position} AS position", f"coalesce(sum({row_bytes}), 0) AS bytes")
        sizes = size if sizes is None else sizes.union(size)
    return [row["bytes"] for row in sorted(sizes.collect())]


def hinted(df: DataFrame, size: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast of a frame of at most ``size`` bytes when that is within the limit.

    Beyond the limit the frame is returned without a hint: Spark then shuffles both sides of its join, and adaptive
    execution splits the hot partitions of the larger one.
    """
    return F.broadcast(df) if size <= limit else df


def broadcast_if_small(*frames: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> list[DataFrame]:
    """Measure the frames in one job and hint a broadcast of those that are small enough."""
    return [hinted(df, size, limit) for df, size in zip(frames, measured_bytes(*frames), strict=True)]
