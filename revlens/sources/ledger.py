"""Records of finished writes, beside the data they speak of.

A write goes to a folder of its own and is recorded last, by one row in a file that appears whole or not at all. Readers take the
folders that the records name, so that half-written ones are never seen and nothing that is being read is overwritten.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RECORD = "number long, name string, n_rows long, parts array<string>, recorded timestamp"


def _path(path: str) -> str:
    return f"{path.rstrip('/')}/_ledger"  # readers of the folder pass over names with an underscore


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every recorded write: its number, name, rows if they were counted, and the parts (such as months) it touched. Nothing recorded: no rows."""
    try:
        return spark.read.schema(RECORD).parquet(_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)


def record(spark: SparkSession, path: str, name: str, n_rows: int | None = None, parts: Sequence[str] = ()) -> None:
    """Add one record, numbered by the writer's clock: a table has one writer at a time."""
    row = spark.createDataFrame([(time.time_ns(), name, n_rows, list(parts))], RECORD.rsplit(",", 1)[0]).selectExpr("*", "current_timestamp() AS recorded")
    row.coalesce(1).write.mode("append").parquet(_path(path))


def newest(spark: SparkSession, path: str) -> str | None:
    """The name of the last recorded write."""
    row = records(spark, path).orderBy("number", "recorded", ascending=False).select("name").first()
    return row and row[0]
