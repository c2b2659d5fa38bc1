"""Several tables that change together: a run stages its slices, and one commit makes all of them visible.

A slice is written to a folder of its run, ``<root>/<table>/<column>=<date>/run=<id>``, where no reader looks yet. The
commit is one small file that names the date, the run and its tables; it is written under another name and renamed, which
either happens or does not. Readers take, for each table and date, the run that the latest commit names. A run that stops
before its commit has changed nothing for them, and can be staged again under its own id or another one.

Commits of a date are numbered. Two runs that commit at the same time want the same number, and the rename lets one of
them have it; the other one takes the next.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sinks.lake import REGENERATED_FLAGS, purged
from daybook.sources.lake import data_file, empty_frame, table_shape

COMMITS = "_commits"
COMMIT_COLUMNS = "day date, number long, run_id string, tables array<string>"
ATTEMPTS = 100


def stage(rows: DataFrame, root: str, table: str, column: str, day: dt.date, run_id: str) -> None:
    """Write the rows of one date for a run; staging a table again replaces what the run had staged.

    Rows of another date fail the write. An empty frame is staged too: it will empty the date.
    """
    same = F.coalesce(F.col(column) == F.lit(day), F.lit(False))
    checked = rows.filter(F.coalesce(F.assert_true(same, f"{column} is not {day}").cast("boolean"), F.lit(True)))
    folder = f"{root}/{table}/{column}={day}/run={run_id}"
    checked.drop(column).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def commit(spark: SparkSession, root: str, day: dt.date, run_id: str, tables: Sequence[str]) -> int:
    """Make the staged slices of a run visible, all at once; the number of the commit."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{root}/{COMMITS}/{day}"
    files = jvm_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_path(folder))
    aside = jvm_path(f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps({"run_id": run_id, "tables": sorted(tables)}), "utf-8"))
    out.close()
    for _ in range(ATTEMPTS):
        number = max(_numbers(files, jvm_path(folder)), default=0) + 1
        target = jvm_path(f"{folder}/{number:08d}.json")
        if not files.exists(target) and files.rename(aside, target):
            return number
    files.delete(aside, False)
    raise RuntimeError(f"{run_id} could not be committed for {day}")


def _numbers(files, folder) -> list[int]:
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [int(name.removesuffix(".json")) for name in names if name[:1] != "_"]


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commits, one row each: a few bytes for each run of a date."""
    folder = f"{root}/{COMMITS}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return empty_frame(spark, COMMIT_COLUMNS)
    read = spark.read.option("recursiveFileLookup", "true").schema("run_id string, tables array<string>").json(folder)
    name = F.col("_metadata.file_path")
    return read.select(
        F.regexp_extract(name, "/([^/]+)/[^/]+$", 1).cast("date").alias("day"),
        F.regexp_extract(name, r"/(\d+)\.json$", 1).cast("long").alias("number"),
        "run_id",
        "tables",
    )


def visible_runs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``day, run_id``: the run that each date of a table is read from."""
    named = commits(spark, root).filter(F.array_contains("tables", table))
    return named.groupBy("day").agg(F.max_by("run_id", "number").alias("run_id"))


def read_committed(spark: SparkSession, root: str, table: str, column: str, day: dt.date | None = None) -> DataFrame | None:
    """The committed rows of a table, or of one date; None when nothing was ever committed.

    The runs are looked up first, one row for each date, and only their folders are read.
    """
    runs = visible_runs(spark, root, table)
    runs = runs if day is None else runs.filter(F.col("day") == F.lit(day))
    folders = [f"{root}/{table}/{column}={r['day']}/run={r['run_id']}" for r in runs.orderBy("day").collect()]
    folders = [folder for folder in folders if data_file(spark, folder) is not None]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{root}/{table}").parquet(*folders)
    return rows.withColumn(column, F.col(column).cast("date")).drop("run")


def purge_run(
    spark: SparkSession,
    root: str,
    day: dt.date,
    run_id: str,
    transactions: str,
    whole_slices: Mapping[str, str],
    flags: Sequence[str] = REGENERATED_FLAGS,
) -> list[str]:
    """Stage the state before a rerun: transactions without those that it creates again, other tables without the date.

    Nothing changes for readers until the returned tables are committed, with what the rerun stages on top or without.
    """
    staged = []
    rows = read_committed(spark, root, transactions, "TRANSACTION_DATE", day)
    if rows is not None:
        stage(purged(rows, day, flags=flags), root, transactions, "TRANSACTION_DATE", day, run_id)
        staged.append(transactions)
    for table, column in whole_slices.items():
        shape = table_shape(spark, f"{root}/{table}")
        if shape is not None:
            stage(empty_frame(spark, shape).withColumn(column, F.lit(day)), root, table, column, day, run_id)
            staged.append(table)
    return staged


def clear_superseded(spark: SparkSession, root: str, table: str, column: str, day: dt.date) -> list[str]:
    """Delete the folders of a date that no commit points to any more, committed once or never; their run ids.

    To be called when no reader that looked up an earlier run is left, and no run of the date is being staged.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/{column}={day}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    visible = {r["run_id"] for r in visible_runs(spark, root, table).filter(F.col("day") == F.lit(day)).collect()}
    cleared = []
    for status in files.listStatus(path) if files.exists(path) else []:
        run_id = status.getPath().getName().removeprefix("run=")
        if run_id not in visible:
            files.delete(status.getPath(), True)
            cleared.append(run_id)
    return sorted(cleared)
