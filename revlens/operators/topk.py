"""Top rows per group that stay even when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str | None = "rank",
    spread: bool = False,
    slices: int = 256,
) -> DataFrame:
    """The first `k` rows of each group under a total order.

    `row_number() <= k` lets every task drop all but `k` rows of a group before the shuffle, for `k`
    up to `spark.sql.optimizer.windowGroupLimitThreshold` (1,000 unless set). What then meets in one task is `k` rows per group and input partition. With `spread`, for rows that
    were not aggregated before, the input partitions are first ranked in `slices` apart, so that the
    last task sees at most `slices * k` rows of a group. The result does not depend on the slices.
    """
    position = rank or "_rank"
    if spread:
        df = df.withColumn("_slice", F.spark_partition_id() % slices)
        inner = Window.partitionBy(*group, "_slice").orderBy(*order)
        df = df.withColumn("_rank", F.row_number().over(inner)).where(F.col("_rank") <= k).drop("_rank", "_slice")
    outer = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(position, F.row_number().over(outer)).where(F.col(position) <= k)
    return ranked if rank else ranked.drop(position)
