"""Joins against master tables.

Masters arrive with a broadcast hint when their measured size allows one (``daybook.sources.masters``), so nothing here
forces a broadcast. Keys are made unique first, so a repeated master row never repeats a posting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_known(df: DataFrame, master: DataFrame, on: str, flag: str) -> DataFrame:
    """Left join to a master of unique keys; the flag is NULL where the master does not know the key."""
    return df.join(master.withColumn(flag, F.lit(1)), on, "left")


def keep_known(df: DataFrame, master: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the master knows."""
    return df.join(master, on, "left_semi")


def keep_known_trimmed(df: DataFrame, master: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose key the master knows, both sides trimmed; stays a hash join."""
    keys = master.select(F.trim(F.col(right)).alias("_known"))
    return df.join(keys, F.trim(df[left]) == F.col("_known"), "left_semi")


def keep_unknown(df: DataFrame, master: DataFrame, condition: str | list[str] | Column) -> DataFrame:
    """Rows without a match in the master."""
    return df.join(master, condition, "left_anti")


def with_rate(balances: DataFrame, rates: DataFrame) -> DataFrame:
    """Left join to the currency rates by CURRENCY = CURRENCY_CODE."""
    return balances.join(rates, balances["CURRENCY"] == rates["CURRENCY_CODE"], "left").drop("CURRENCY_CODE")


def files_of_frequency(control: DataFrame, types: DataFrame, frequency: str, prefix: Column) -> DataFrame:
    """Control rows whose file-name prefix is a file type due at ``frequency`` (D, M or Y)."""
    due = types.filter(F.contains(F.col("FREQUENCY"), F.lit(frequency))).select(F.col("FILE_PATTERN").alias("_due"))
    return control.join(due, prefix == F.col("_due"), "left_semi")
