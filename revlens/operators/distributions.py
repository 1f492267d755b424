"""Chart data: frequencies, histograms, densities and box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from revlens.functions.text import each, words
from revlens.functions.vocab import STOP_WORDS
from revlens.operators.quantiles import box_stats


def frequency(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key; missing keys are left out."""
    return df.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("count"))


def mean_score_by_rating(df: DataFrame, ratings: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Mean sentiment score per bank, one column per rating, and one for ratings besides."""
    means = [F.avg(F.when(F.col("rating") == r, F.col("sentiment_score"))).alias(f"rating_{r}") for r in ratings]
    other = F.avg(F.when(~F.col("rating").isin(list(ratings)), F.col("sentiment_score"))).alias("rating_other")
    return df.where("bank is not null").groupBy("bank").agg(*means, other)


def score_histogram(df: DataFrame, group: str, value: str, bins: int = 10, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rows per group and equal-width bin; empty bins are present, the last bin takes its upper edge.

    Bin 0 holds what lies below the range (it has no start), bin `bins + 1` what lies above.
    """
    width = (high - low) / bins
    inside = F.least(F.floor((F.col(value) - low) / width) + 1, F.lit(bins))
    bin_no = F.when(F.col(value) < low, 0).when(F.col(value) > high, bins + 1).otherwise(inside).cast("long")
    counts = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group, bin_no.alias("bin")).agg(F.count("*").alias("count"))
    every = counts.select(group).distinct().select(
        group, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins + 1).cast("long"))).alias("bin")
    )
    return every.join(counts, [group, "bin"], "left").select(
        group,
        "bin",
        F.when(F.col("bin") > 0, low + (F.col("bin") - 1) * width).alias("bin_start"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


def score_density(df: DataFrame, group: str, value: str, points: int = 21, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Gaussian kernel density per group on an even grid, bandwidth n^(-1/5) times the deviation.

    The sums of all grid points are one aggregation, combined before the shuffle: what moves is one row per group and task.
    """
    values = df.select(group, F.col(value).cast("double").alias("_x")).dropna()
    stats = values.groupBy(group).agg(F.count("*").alias("_n"), F.stddev_samp("_x").alias("_sd"))
    widths = stats.where("_sd > 0").select(group, "_n", (F.col("_sd") * F.pow("_n", F.lit(-0.2))).alias("_h"))
    grid = [low + i * ((high - low) / (points - 1)) for i in range(points)]
    z = [(F.lit(x) - F.col("_x")) / F.col("_h") for x in grid]
    sums = (
        values.join(widths, group)
        .groupBy(group, "_n", "_h")
        .agg(F.array(*[F.struct(F.lit(x).alias("x"), F.sum(F.exp(-0.5 * zi * zi)).alias("s")) for x, zi in zip(grid, z, strict=True)]).alias("_g"))
    )
    density = F.col("_p.s") / (F.col("_n") * F.col("_h") * F.sqrt(2 * F.pi()))
    return sums.select(group, "_n", "_h", F.explode("_g").alias("_p")).select(group, F.col("_p.x").alias("x"), density.alias("density"))


def likes_by_rating(df: DataFrame) -> DataFrame:
    return box_stats(df, ["rating"], "thumbs_up")


def compound_by_rating(df: DataFrame) -> DataFrame:
    return box_stats(df, ["rating"], "compound")


def word_frequencies(df: DataFrame, text: str, top_n: int = 200, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The most frequent words of all texts, stop words left out: word-cloud weights."""
    kept = F.filter(words(text), lambda word: ~word.isin(list(stop_words)))
    counts = df.select(each(kept).alias("word")).where("word is not null").groupBy("word").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "word").limit(top_n)


def keyword_frequencies(df: DataFrame, sentiment: str = "positive", keywords: str = "keywords") -> DataFrame:
    rows = df.where(F.col("sentiment_label") == sentiment).select(F.explode(keywords).alias("keyword"))
    return rows.where("keyword is not null").groupBy("keyword").agg(F.count("*").alias("count"))
