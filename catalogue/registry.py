"""Named queries and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function `(spark, folder) -> DataFrame`, with its SQL if there is any."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
