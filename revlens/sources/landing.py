"""Raw review pages as they land: newest reviews per bank, cleaned, with a volume check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from revlens.functions.dates import date_text
from revlens.operators.columns import constant_columns
from revlens.operators.rows import drop_missing, newest_per_key
from revlens.operators.topk import top_per_group

MIN_REVIEWS = 400


def newest_reviews(raw: DataFrame, max_reviews: int | None = None, group: str = "bank") -> DataFrame:
    """The newest `max_reviews` reviews of each bank, ties to the smallest id; all without a number."""
    if max_reviews is None:
        return raw
    order = [F.desc_nulls_last("review_ts"), F.col("review_id")]
    return top_per_group(raw, [group], order, max_reviews, rank=None, spread=True)


def with_bank_names(raw: DataFrame, banks_by_app: Mapping[str, str], app: str = "app_id") -> DataFrame:
    """Name the bank of each app; rows of unknown apps are left out, `of_unknown_apps` has them."""
    names = raw.sparkSession.createDataFrame(list(banks_by_app.items()), f"{app} string, bank string")
    return raw.join(names, app)


def of_unknown_apps(raw: DataFrame, banks_by_app: Mapping[str, str], app: str = "app_id") -> DataFrame:
    """The rows that `with_bank_names` leaves out, those without an app included."""
    known = raw.sparkSession.createDataFrame([(a,) for a in banks_by_app], f"{app} string")
    return raw.join(known, app, "left_anti")


def clean_reviews(raw: DataFrame, source: str = "Google Play", keys: Sequence[str] = ("bank",), drop_missing_first: bool = False) -> DataFrame:
    """Raw reviews to the cleaned table: one row per bank, review text and day, the newest.

    A repeat is judged within its bank. As in the incremental feed, repeats go before incomplete
    rows, so a day's newest copy without a rating takes the older copies with it;
    `drop_missing_first` reverses the order.
    """
    named = raw.withColumn("date", date_text("review_ts")).select(
        "review_id", *keys, F.col("content").alias("review"), F.col("score").alias("rating"), "date", "review_ts"
    )
    steps = [lambda df: newest_per_key(df, [*keys, "review", "date"], "review_ts", "review_id"), lambda df: drop_missing(df, ["review", "rating"])]
    for step in reversed(steps) if drop_missing_first else steps:
        named = step(named)
    cleaned = constant_columns(named, source=source)
    return cleaned.select("review_id", "review", "rating", "date", *keys, "source", "review_ts")


def volume_check(cleaned: DataFrame, banks: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Cleaned rows per expected bank (`banks(name)`), banks without any row included."""
    counts = cleaned.groupBy(F.col("bank").alias("name")).agg(F.count("*").alias("n"))
    return banks.select("name").join(counts, "name", "left").select(
        F.col("name").alias("bank"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.lit(min_reviews).alias("min_required"),
        (F.coalesce("n", F.lit(0)) >= min_reviews).alias("ok"),
    )


def combine(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of several cleaned tables; columns a table lacks become NULL."""
    if not tables:
        raise ValueError("no tables to combine")
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
