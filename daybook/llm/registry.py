"""Queries of the corpus operators, and the SQL they must agree with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CorpusQuery = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, CorpusQuery] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[CorpusQuery], CorpusQuery]:
    def register(function: CorpusQuery) -> CorpusQuery:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register
