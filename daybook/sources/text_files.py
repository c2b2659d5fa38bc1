"""Raw text files and the control table that names them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import bare_file_name, file_name_part
from daybook.functions.text import LOOSE_FILE_PATTERN


def read_lines(spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Lines of text files with the path and bare name of their file.

    A gzip file is one task whatever its size. Where files are fewer than cores, ``partitions`` spreads the lines
    afterwards; it costs a shuffle of the raw text, so it is off unless asked for.
    """
    lines = spark.read.text(paths).select(
        "value",
        bare_file_name("_metadata.file_path").alias("FILE_NAME"),
        F.col("_metadata.file_path").alias("SOURCE_PATH"),
    )
    return lines.repartition(partitions) if partitions else lines


def control_slice(
    control: DataFrame, etl_date: str, file_type: str, name_prefix: str = "", announcing_rows: bool = True
) -> DataFrame:
    """Control rows of one date and file type that announce rows, optionally of one name prefix.

    Account files count as announced with any number of rows: pass ``announcing_rows=False`` for them.
    """
    rows = control.filter((F.col("ETL_DATE") == etl_date) & (F.col("FILE_TYPE") == file_type))
    rows = rows.filter(F.col("HDFS_ROW_COUNT") > 0) if announcing_rows else rows
    return rows.filter(F.startswith(F.col("FILE_NAME"), F.lit(name_prefix))) if name_prefix else rows


def control_paths(
    control: DataFrame, base: str, pattern: str = LOOSE_FILE_PATTERN, lower_stream: bool = True
) -> DataFrame:
    """FILE_NAME, STREAM and PATH of the files that the control table announces; names that do not fit are left out."""
    stream = file_name_part("FILE_NAME", "stream", pattern)
    named = control.select("FILE_NAME", (F.lower(stream) if lower_stream else stream).alias("STREAM"))
    return named.filter(F.col("STREAM").isNotNull()).withColumn("PATH", _path(base))


def control_paths_direct(control: DataFrame, base: str) -> DataFrame:
    """The same where the control table has the stream as a column."""
    return control.select("FILE_NAME", "STREAM").distinct().withColumn("PATH", _path(base))


def _path(base: str):
    return F.concat(F.lit(f"{base}/"), F.col("STREAM"), F.lit("/"), F.col("FILE_NAME"), F.lit(".gz"))


def path_list(paths: DataFrame) -> list[str]:
    """Paths as a list for ``read_lines``: one string per file, as the file reader wants them."""
    return [row["PATH"] for row in paths.select("PATH").collect()]


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with scheme and host and without a slash at its end, as listings give it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """PATH of every file below a folder, qualified. Only the listing is read, no file content."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listing.select(F.col("path").alias("PATH"))


def split_by_presence(expected: DataFrame, present: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Expected paths that exist, and those that do not. ``present`` may repeat a path, once per line for example."""
    present = present.distinct()
    return expected.join(present, "PATH", "left_semi"), expected.join(present, "PATH", "left_anti")


def day_globs(folder: str, day: dt.date, stream_types: Sequence[str], other_types: Sequence[str]) -> list[str]:
    """Path patterns of a day: numbered stream files, and files of other types whose name ends in no digit."""
    stamp = day.strftime("%d%m%Y")
    numbered = [f"{folder}/{t}_{stamp}_*_[0-9][0-9][0-9].gz" for t in stream_types]
    return numbered + [f"{folder}/{t}_{stamp}_*[!0-9].gz" for t in other_types]
