"""Date-partitioned lake tables, fallbacks between sources, typed empty frames."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

# Names that Spark gives to reads of a table that is not there.
ABSENT_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")

# Shapes of the frames that stand in for missing sources.
EMPTY_OPENING = "glcc string, BALANCE decimal(25,4)"
EMPTY_GL = "GLCC string, GL_BALANCE decimal(25,4)"
EMPTY_CBS = "GLCC string, CBS_BALANCE decimal(25,4)"
EMPTY_PREVIOUS = "GLCC string, YESTERDAY_DIFFERENCE decimal(25,4), FIRST_ERROR_DATE date"
EMPTY_PROFIT = "GLCC string, BALANCE decimal(25,4)"


def read_lake(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A lake table; ``merge_schema`` for tables whose later appends brought new columns."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_slice(spark: SparkSession, path: str, column: str, day: dt.date) -> DataFrame:
    """One date of a lake table; the filter on the partition column prunes the other dates."""
    return read_lake(spark, path).filter(F.col(column) == F.lit(day))


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because its table does not exist or has no file yet."""
    return error.getCondition() in ABSENT_CONDITIONS


def data_file(spark: SparkSession, path: str) -> str | None:
    """Some data file of a table, or None when it has none. Folders are listed down to the first file, none is opened."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())

    def first(folder) -> str | None:
        inside = sorted(files.listStatus(folder), key=lambda s: s.getPath().getName(), reverse=True)
        for status in inside:
            if status.isFile() and status.getPath().getName().startswith("part-"):
                return status.getPath().toString()
        below = (first(s.getPath()) for s in inside if s.isDirectory() and s.getPath().getName()[:1] not in ("_", "."))
        return next((found for found in below if found), None)

    return first(base) if files.exists(base) else None


def table_shape(spark: SparkSession, path: str) -> StructType | None:
    """Columns of a table without those of its folders, from the footer of one file; None when there is no file."""
    found = data_file(spark, path)
    return None if found is None else spark.read.option("recursiveFileLookup", "true").parquet(found).schema


def find_slice(spark: SparkSession, path: str, column: str, day: dt.date) -> DataFrame | None:
    """One date of a lake table, or None when there is no such table. Only the folder of the date is listed."""
    folder = f"{path}/{column}={day}"
    if data_file(spark, folder) is not None:
        rows = spark.read.option("basePath", path).parquet(folder)
        return rows.withColumn(column, F.col(column).cast("date"))
    # a table without the date gives no rows, one that is not divided by this column an error
    return None if data_file(spark, path) is None else read_slice(spark, path, column, day)


def empty_frame(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """A typed frame without rows, the identity of a union."""
    return spark.createDataFrame([], schema)


def _is_failed_connection(error: Py4JJavaError) -> bool:
    """Whether a database could not be reached: an SQLState of class 08 somewhere down the causes.

    A missing driver and a URL that no driver takes have such a state too, but are mistakes in the settings.
    """
    cause = error.java_exception
    while cause is not None:
        if cause.getClass().getName().startswith("java.sql.") and cause.getSQLState():
            return cause.getSQLState().startswith("08") and "No suitable driver" not in (cause.getMessage() or "")
        cause = cause.getCause()
    return False


def first_available(
    spark: SparkSession,
    loaders: Sequence[tuple[str, Callable[[], DataFrame | None]]],
    empty: str | StructType | None = None,
) -> tuple[DataFrame, str]:
    """The first source that exists, with its name.

    A loader that gives None, an absent table or a database that can't be reached leads on to the next source; wrong
    settings, wrong columns and errors in the data surface. When no source is left, ``empty`` is the type of the frame
    without rows that stands in, named ``empty``; without it that is an error.
    """
    for name, load in loaders:
        try:
            found = load()
            if found is not None:
                return found, name
            log.warning("source %s has nothing", name)
        except AnalysisException as error:
            if not is_absent(error):
                raise
            log.warning("source %s is absent", name)
        except Py4JJavaError as error:
            if not _is_failed_connection(error):
                raise
            log.warning("source %s can't be reached: %s", name, error.java_exception.getClass().getName())
    if empty is None:
        raise LookupError(f"none of {[name for name, _ in loaders]} is there")
    return empty_frame(spark, empty), "empty"


def present_slice(spark: SparkSession, path: str, column: str, day: dt.date) -> DataFrame | None:
    """One date of a lake table, or None when the table or the date is absent; at most one row is read."""
    rows = find_slice(spark, path, column, day)
    return None if rows is None or rows.isEmpty() else rows


def latest_partition(spark: SparkSession, path: str, column: str) -> dt.date | None:
    """The latest date of a lake table, from the names of its partition folders: no file is opened.

    The listing has one entry per date, and only folders with a data file count.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(base):
        return None
    folders = [s.getPath() for s in files.listStatus(base) if s.isDirectory() and s.getPath().getName().startswith(f"{column}=")]
    for folder in sorted(folders, key=lambda f: f.getName(), reverse=True):
        if any(s.getPath().getName().startswith("part-") for s in files.listStatus(folder)):
            return dt.date.fromisoformat(folder.getName().removeprefix(f"{column}="))
    return None
