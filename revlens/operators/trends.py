"""Time series of ratings and sentiments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from revlens.functions.dates import week_ending

LABELS = ("negative", "neutral", "positive")


def daily_mean_rating(df: DataFrame, day: str = "date", rating: str = "rating") -> DataFrame:
    """Mean rating per day from the first to the last day; days without reviews have no mean."""
    daily = df.select(F.to_date(day).alias("day"), rating).where("day is not null").groupBy("day")
    daily = daily.agg(F.avg(rating).alias("mean_rating"), F.count("*").alias("n"))
    ends = daily.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null")
    calendar = ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    return calendar.join(daily, "day", "left").select("day", "mean_rating", F.coalesce("n", F.lit(0)).alias("n"))


def _label_columns(df: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Rows per key, a column per label and `other` for every label besides."""
    labelled = df.where(F.col(key).isNotNull() & F.col("sentiment_label").isNotNull())
    counts = [F.count(F.when(F.col("sentiment_label") == label, 1)).alias(label) for label in labels]
    other = F.count(F.when(~F.col("sentiment_label").isin(list(labels)), 1)).alias("other")
    return labelled.groupBy(key).agg(*counts, other)


def daily_sentiment(df: DataFrame, day: str = "date", labels: Sequence[str] = LABELS) -> DataFrame:
    """Reviews per day and sentiment, one column per sentiment; only days with reviews."""
    return _label_columns(df.select(F.to_date(day).alias("day"), "sentiment_label"), "day", labels)


def weekly_sentiment(df: DataFrame, day: str = "date", labels: Sequence[str] = LABELS) -> DataFrame:
    """Reviews per week and sentiment; a week is named by the Sunday that ends it, empty weeks are absent."""
    return _label_columns(df.select(week_ending(day).alias("week_ending"), "sentiment_label"), "week_ending", labels)
