"""Staged tables, Arrow batches and connected components, shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import fresh_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> pa.Array:
    """The column as plain strings, null as empty; not copied if nothing is to be done."""
    column = column if column.type == pa.string() else column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def pieces(column: pa.Array, target: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about `target` bytes, so that work arrays stay small; a longer text is a range of its own."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + target, side="right")))
        yield start, stop
        start = stop


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the one before left behind is given back to the system, because workers live on between tasks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    gc.collect()  # functions that travelled with earlier tasks, and the arrays they hold, refer to each other in circles
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)



def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b): one row (node, component) per node that has an edge to another.

    `component` is the smallest node of the component. Large-star and small-star steps alternate until no
    edge changes; minima are combined before they move and joined back, so a hub with many neighbours is split
    by the adaptive join. Each round ends in the shared folder. Null ends and loops are ignored.
    """
    current = staged(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while True:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        following = staged(small, "edges")
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        if following.agg(F.count("*"), mark).first() == current.agg(F.count("*"), mark).first():
            break
        current = following
    centre = F.col("b").alias("component")
    return current.select(F.col("a").alias("node"), centre).union(current.select(F.col("b").alias("node"), centre).distinct())
