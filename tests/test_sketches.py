"""Distinct sketches per day, merged, against exact counts."""

from pyspark.sql import functions as F

from revlens.operators import profile


def test_merged_days_are_near_the_exact_counts(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 20_011).alias("user"), (F.col("id") % 7).cast("string").alias("kind"), F.lit(None).cast("string").alias("none"))
    sketches = profile.distinct_sketches(rows, F.col("day"), ["user", "kind", "none"])
    assert sketches.count() == 90
    bound = 4 * 1.04 / 2 ** (profile.SKETCH_LG / 2)
    for days in (30, 10, 1):
        exact = {r.column_name: r.n_distinct for r in profile.distinct_counts(rows.where(F.col("day") < days).drop("day")).collect()}
        for r in profile.distinct_over(sketches.where(F.col("part") < days)).collect():
            assert abs(r.n_estimated - exact[r.column_name]) <= max(1, bound * exact[r.column_name])
    assert profile.distinct_over(sketches.where("false")).collect() == []
