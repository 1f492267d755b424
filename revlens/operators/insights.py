"""Drivers and pain points: theme counts per bank and sentiment, and the report rows built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from revlens.functions.text import each
from revlens.operators.topk import top_per_group

DRIVER, PAIN = "positive", "negative"


def _by_count() -> list:
    return [F.desc("count"), F.col("theme")]


def theme_rows(df: DataFrame, columns: Sequence[str], themes: str = "themes") -> DataFrame:
    """One row per review and theme; reviews without a theme, or without a value to group by, vanish."""
    rows = df.select(*columns, each(F.col(themes)).alias("theme"))
    return rows.dropna(subset=[*columns, "theme"])


def theme_counts(df: DataFrame, columns: Sequence[str] = (), themes: str = "themes") -> DataFrame:
    return theme_rows(df, columns, themes).groupBy(*columns, "theme").agg(F.count("*").alias("count"))


def theme_summary(df: DataFrame) -> DataFrame:
    """Theme counts by bank and sentiment, the most frequent theme of each pair first."""
    counts = theme_counts(df, ["bank", "sentiment_label"])
    return counts.orderBy("bank", "sentiment_label", F.desc("count"), "theme")


def top_themes(df: DataFrame, top_n: int = 3) -> DataFrame:
    """The leading themes of each bank among positive reviews (drivers) and negative ones (pain points).

    All banks and both sentiments come from one aggregation; ranking sees only the counts.
    """
    counts = theme_counts(df.where(F.col("sentiment_label").isin(DRIVER, PAIN)), ["bank", "sentiment_label"])
    return top_per_group(counts, ["bank", "sentiment_label"], _by_count(), top_n)


def top_themes_by_bank(df: DataFrame, top_n: int = 5) -> DataFrame:
    return top_per_group(theme_counts(df, ["bank"]), ["bank"], _by_count(), top_n)


def insight_tree(df: DataFrame, top_n: int = 3) -> DataFrame:
    """One row per bank with two ordered lists of (theme, count)."""
    ranked = top_themes(df, top_n)

    def best(label: str):
        return F.array_sort(F.collect_list(F.when(F.col("sentiment_label") == label, F.struct("rank", "theme", "count"))))

    lists = ranked.groupBy("bank").agg(best(DRIVER).alias("top_drivers"), best(PAIN).alias("top_pain_points"))
    short = [F.transform(name, lambda t: F.struct(t["theme"].alias("theme"), t["count"].alias("count"))).alias(name) for name in lists.columns[1:]]
    return lists.select("bank", *short)


def driver_pain_table(df: DataFrame, top_n: int = 3) -> DataFrame:
    """Drivers and pain points side by side by rank; the shorter list ends in blanks."""
    ranked = top_themes(df, top_n)

    def cell(label: str, column: str):
        return F.coalesce(F.max(F.when(F.col("sentiment_label") == label, F.col(column).cast("string"))), F.lit(""))

    return ranked.groupBy("bank", "rank").agg(
        cell(DRIVER, "theme").alias("driver"),
        cell(DRIVER, "count").alias("driver_count"),
        cell(PAIN, "theme").alias("pain_point"),
        cell(PAIN, "count").alias("pain_point_count"),
    )


def theme_weights(summary: DataFrame, sentiment: str = DRIVER, bank: str | None = None) -> DataFrame:
    """Summed theme counts of one sentiment, over all banks or one: word-cloud weights."""
    rows = summary.where(F.col("sentiment_label") == sentiment)
    if bank is not None:
        rows = rows.where(F.col("bank") == bank)
    return rows.groupBy("theme").agg(F.sum("count").alias("weight"))


def largest_themes(summary: DataFrame, bank: str, sentiment: str = DRIVER, top_n: int = 5) -> DataFrame:
    """The `top_n` rows with the highest count for one bank and sentiment."""
    rows = summary.where((F.col("bank") == bank) & (F.col("sentiment_label") == sentiment))
    return rows.orderBy(F.desc("count"), "theme").limit(top_n)


def chart_set(df: DataFrame, top_n: int = 5) -> DataFrame:
    """Bars and word-cloud weights for every bank and sentiment in one table."""
    counts = theme_counts(df.where(F.col("sentiment_label").isin(DRIVER, PAIN)), ["bank", "sentiment_label"])
    bars = top_per_group(counts, ["bank", "sentiment_label"], _by_count(), top_n, rank=None)
    return bars.select(F.lit("bar").alias("chart"), "bank", "sentiment_label", "theme", "count").unionByName(
        counts.select(F.lit("cloud").alias("chart"), "bank", "sentiment_label", "theme", "count")
    )


def report_lines(df: DataFrame, top_n: int = 3) -> DataFrame:
    """The text page of each bank, line by line: heading, drivers, pain points."""
    # A bank has at most 2 * top_n ranked themes, so its page is a short list.
    ranked = top_themes(df, top_n)
    line = F.format_string("   - %s (%d)", F.col("theme"), F.col("count"))

    def lines(label: str):
        return F.array_sort(F.collect_list(F.when(F.col("sentiment_label") == label, F.struct("rank", line.alias("line")))))

    pages = df.where("bank is not null").select("bank").distinct().join(
        ranked.groupBy("bank").agg(lines(DRIVER).alias("_d"), lines(PAIN).alias("_p")), "bank", "left"
    )
    none = F.array().cast("array<string>")
    # The headings of the page.
    page = F.concat(
        F.array(
            F.concat(F.lit("📌 Insights for "), F.col("bank")), F.lit(""), F.lit("✅ Top Drivers (Positive Themes):")
        ),
        F.coalesce(F.col("_d.line"), none),
        F.array(F.lit(""), F.lit("❌ Top Pain Points (Negative Themes):")),
        F.coalesce(F.col("_p.line"), none),
    )
    return pages.select("bank", F.posexplode(page).alias("line_no", "line"))
