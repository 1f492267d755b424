"""Frequencies, histograms, densities, box plots and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.lexicon_sql import compound_ctes
from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, LABELLED_SQL, REVIEWS_SQL, cleaned, labelled, reviews, scored
from revlens.functions.vocab import STOP_WORDS
from revlens.operators import distributions as ops, trends
from revlens.operators.lexicon import add_compound
from revlens.operators.quantiles import box_stats

CLEANED = f"WITH {CLEANED_SQL} "
LABELLED = f"WITH {LABELLED_SQL} "
SCORED = f"WITH {LABELLED_SQL}, {compound_ctes('labelled', 'review_id', 'review')}, scored AS (SELECT l.*, c.compound, (c.compound + 1) / 2 AS sentiment_score FROM labelled l JOIN compounds c ON c.id = l.review_id) "
BOX_COLUMNS = ("q1", "median", "q3", "whisker_low", "whisker_high")


def _box_sql(source: str, group: str, value: str, digits: int = 6) -> str:
    return f"""q AS (SELECT {group}, count({value}) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
      quantile_cont({value}, 0.75) AS q3 FROM {source} WHERE {group} IS NOT NULL AND {value} IS NOT NULL GROUP BY 1)
    SELECT q.{group}, q.n, round(q1, {digits}) AS q1, round(median, {digits}) AS median, round(q3, {digits}) AS q3,
      round(CAST(min({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), {digits}) AS whisker_low,
      round(CAST(max({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), {digits}) AS whisker_high,
      count(*) FILTER (WHERE {value} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM q JOIN {source} s ON s.{group} = q.{group} WHERE {value} IS NOT NULL GROUP BY ALL"""


def _rounded(df, *keys):
    return df.select(*keys, "n", *[F.round(c, 6).alias(c) for c in BOX_COLUMNS], "n_outliers")


@query("rating_distribution", CLEANED + "SELECT rating, count(*) AS count FROM cleaned GROUP BY ALL")
def rating_distribution(spark, folder):
    return ops.frequency(cleaned(spark, folder), "rating")


@query("sentiment_distribution", LABELLED + "SELECT sentiment_label, count(*) AS count FROM labelled WHERE sentiment_label IS NOT NULL GROUP BY ALL")
def sentiment_distribution(spark, folder):
    return ops.frequency(labelled(spark, folder), "sentiment_label")


@query("sentiment_by_bank", LABELLED + "SELECT bank, sentiment_label, count(*) AS count FROM labelled WHERE sentiment_label IS NOT NULL GROUP BY ALL")
def sentiment_by_bank(spark, folder):
    return ops.frequency(labelled(spark, folder), "bank", "sentiment_label")


@query(
    "mean_score_by_bank_and_rating",
    SCORED + "SELECT bank, " + ", ".join(f"round(avg(sentiment_score) FILTER (WHERE rating = {r}), 6) AS rating_{r}" for r in range(1, 6))
    + ", round(avg(sentiment_score) FILTER (WHERE rating NOT BETWEEN 1 AND 5), 6) AS rating_other FROM scored GROUP BY bank",
)
def mean_score_by_bank_and_rating(spark, folder):
    means = ops.mean_score_by_rating(scored(spark, folder))
    return means.select("bank", *[F.round(c, 6).alias(c) for c in means.columns[1:]])


@query(
    "score_histogram",
    SCORED + """, bins AS (SELECT bank, unnest(generate_series(0, 11)) AS bin FROM (SELECT DISTINCT bank FROM scored)),
      filled AS (SELECT bank, CASE WHEN sentiment_score < 0 THEN 0 WHEN sentiment_score > 1 THEN 11 ELSE least(CAST(floor(sentiment_score / CAST(0.1 AS DOUBLE)) AS BIGINT) + 1, 10) END AS bin, count(*) AS n FROM scored GROUP BY ALL)
    SELECT b.bank, b.bin, CASE WHEN b.bin > 0 THEN round((b.bin - 1) * CAST(0.1 AS DOUBLE), 6) END AS bin_start, coalesce(h.n, 0) AS count FROM bins b LEFT JOIN filled h ON h.bank = b.bank AND h.bin = b.bin""",
)
def score_histogram(spark, folder):
    bars = ops.score_histogram(scored(spark, folder), "bank", "sentiment_score", 10)
    return bars.withColumn("bin_start", F.round("bin_start", 6))


@query(
    "score_density",
    SCORED + """, stats AS (SELECT bank, count(*) AS n, stddev_samp(sentiment_score) * pow(count(*), -0.2) AS h FROM scored GROUP BY bank),
      grid AS (SELECT s.bank, s.sentiment_score, t.n, t.h, unnest(generate_series(0, 20)) AS i FROM scored s JOIN stats t ON t.bank = s.bank WHERE t.h > 0)
    SELECT bank, round(i * CAST(0.05 AS DOUBLE), 6) AS x, round(sum(exp(-0.5 * pow((i * CAST(0.05 AS DOUBLE) - sentiment_score) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
    FROM grid GROUP BY bank, i""",
)
def score_density(spark, folder):
    curve = ops.score_density(scored(spark, folder), "bank", "sentiment_score", 21)
    return curve.select("bank", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@query("likes_by_rating", f"WITH {REVIEWS_SQL}, rated AS (SELECT score AS rating, thumbs_up FROM reviews), {_box_sql('rated', 'rating', 'thumbs_up')}")
def likes_by_rating(spark, folder):
    rows = reviews(spark, folder).withColumnRenamed("score", "rating")
    return _rounded(ops.likes_by_rating(rows), "rating")


@query("event_value_boxes", f"WITH {_box_sql('events', 'event_type', 'value')}")
def event_value_boxes(spark, folder):
    return _rounded(box_stats(table(spark, folder, "events"), ["event_type"], "value"), "event_type")


@query("price_boxes", f"WITH {_box_sql('lineitem', 'l_returnflag', 'l_extendedprice')}")
def price_boxes(spark, folder):
    return _rounded(box_stats(table(spark, folder, "lineitem"), ["l_returnflag"], "l_extendedprice"), "l_returnflag")


@query("lexicon_sentiment_by_rating", SCORED + f", {_box_sql('scored', 'rating', 'compound')}")
def lexicon_sentiment_by_rating(spark, folder):
    rows = add_compound(cleaned(spark, folder), "review")
    return _rounded(ops.compound_by_rating(rows), "rating")


STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "word_frequencies",
    CLEANED + rf"""SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(review), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM cleaned)
    WHERE word NOT IN ({STOPS}) GROUP BY ALL ORDER BY count DESC, word LIMIT 200""",
)
def word_frequencies(spark, folder):
    return ops.word_frequencies(cleaned(spark, folder), "review", 200)


@query(
    "daily_mean_rating",
    CLEANED + """, daily AS (SELECT CAST(date AS DATE) AS day, avg(rating) AS m, count(*) AS n FROM cleaned WHERE date IS NOT NULL GROUP BY 1),
      calendar AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
    SELECT CAST(c.day AS VARCHAR) AS day, round(m, 6) AS mean_rating, coalesce(n, 0) AS n FROM calendar c LEFT JOIN daily d ON d.day = c.day""",
)
def daily_mean_rating(spark, folder):
    daily = trends.daily_mean_rating(cleaned(spark, folder))
    return daily.select(F.col("day").cast("string").alias("day"), F.round("mean_rating", 6).alias("mean_rating"), "n")


@query(
    "daily_mean_order_price",
    """WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS m, count(*) AS n FROM orders GROUP BY 1),
      calendar AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
    SELECT CAST(c.day AS VARCHAR) AS day, round(m, 6) AS mean_rating, coalesce(n, 0) AS n FROM calendar c LEFT JOIN daily d ON d.day = c.day""",
)
def daily_mean_order_price(spark, folder):
    # Whole cents add up to the same sum in any order.
    cents = table(spark, folder, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    daily = trends.daily_mean_rating(cents, "o_orderdate", "cents")
    return daily.select(F.col("day").cast("string").alias("day"), F.round("mean_rating", 6).alias("mean_rating"), "n")


def _by_label(key: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE sentiment_label = '{label}') AS {label}" for label in trends.LABELS)
    return f"{counts}, count(*) FILTER (WHERE sentiment_label NOT IN {trends.LABELS}) AS other FROM labelled WHERE date IS NOT NULL AND sentiment_label IS NOT NULL GROUP BY {key}"


@query("daily_sentiment", LABELLED + f"SELECT date AS day, {_by_label('date')}")
def daily_sentiment(spark, folder):
    rows = trends.daily_sentiment(labelled(spark, folder))
    return rows.withColumn("day", F.col("day").cast("string"))


@query(
    "weekly_sentiment",
    LABELLED + f"SELECT CAST(CAST(date_trunc('week', CAST(date AS DATE)) AS DATE) + 6 AS VARCHAR) AS week_ending, {_by_label('1')}",
)
def weekly_sentiment(spark, folder):
    rows = trends.weekly_sentiment(labelled(spark, folder))
    return rows.withColumn("week_ending", F.col("week_ending").cast("string"))
