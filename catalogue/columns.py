"""Projections, schema operators and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, REVIEWS_SQL, cleaned, reviews
from revlens.functions import dates
from revlens.operators import columns as ops

RAW = f"WITH {REVIEWS_SQL} "


@query("select_columns", RAW + "SELECT content, score, CAST(review_ts AS VARCHAR) AS posted FROM reviews")
def select_columns(spark, folder):
    return reviews(spark, folder).select("content", "score", F.col("review_ts").cast("string").alias("posted"))


@query("rename_columns", RAW + "SELECT review_id, content AS review, score AS rating, bank FROM reviews")
def rename_columns(spark, folder):
    rows = reviews(spark, folder).select("review_id", "content", "score", "bank")
    return ops.rename_columns(rows, {"content": "review", "score": "rating", "absent": "x"})


@query("rename_columns_first", RAW + "SELECT thumbs_up AS likes, user_name AS author, review_id, bank FROM reviews")
def rename_columns_first(spark, folder):
    rows = reviews(spark, folder).select("review_id", "user_name", "bank", "thumbs_up")
    return ops.rename_first(rows, {"thumbs_up": "likes", "user_name": "author", "absent": "x"})


@query("constant_columns", "SELECT doc_id, 'Example Bank' AS bank, 'Google Play' AS source FROM documents")
def constant_columns(spark, folder):
    return ops.constant_columns(table(spark, folder, "documents").select("doc_id"), bank="Example Bank", source="Google Play")


@query("tidy_column_names", "SELECT event_id, user_id, event_type FROM events")
def tidy_column_names(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return ops.tidy_names(rows.toDF(" Event ID", "USER id ", "Event Type"))


@query("drop_redundant_columns", "SELECT doc_id, lang, source FROM documents")
def drop_redundant_columns(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source", "n_chars")
    return ops.drop_redundant_columns(rows.toDF("doc_id", "unnamed:_0", "lang", "source", "lang"))


@query("tidy_columns", "SELECT doc_id, lang FROM documents")
def tidy_columns(spark, folder):
    rows = table(spark, folder, "documents").select("n_chars", "doc_id", "lang", "source")
    return ops.tidy_columns(rows.toDF("Unnamed: 0", "Doc ID", "Lang", "LANG "))


@query("drop_columns", RAW + "SELECT review_id, bank, lang FROM reviews")
def drop_columns(spark, folder):
    return ops.drop_columns(reviews(spark, folder), ["user_name", "thumbs_up", "content", "score", "review_ts", "absent"])


@query("drop_empty_columns", "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def drop_empty_columns(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels"), "doc_id", "left")
    empty = F.when(F.col("doc_id") < 0, F.col("toxic"))
    return ops.drop_empty_columns(rows.withColumns({"toxic": empty, "reply": F.when(F.col("lang") == "", F.col("lang"))}))


# Zones that follow a time, and their hours east of UTC; the last is unknown.
ZONES = (("+03:00", 3), ("+0300", 3), ("Z", 0), ("+03", 3), (" UTC+3", 3), (" Asia/Tokyo", 9), (" Nowhere/Land", None))
_ZONE_TEXTS = ", ".join(f"'{text}'" for text, _ in ZONES)
_ZONE_HOURS = ", ".join("NULL" if hours is None else str(hours) for _, hours in ZONES)
DATED = f"""typed AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'N/A' WHEN 'signup' THEN ' NaT ' WHEN 'view' THEN 'soon'
      WHEN 'click' THEN '  ' || CAST(ts AS VARCHAR) || ' ' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || [{_ZONE_TEXTS}][event_id % 7 + 1] END AS posted_time,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS "date" FROM events)"""


def _dated(spark, folder):
    events = table(spark, folder, "events")
    ts = F.col("ts")
    posted = (
        F.when(F.col("event_type") == "error", "N/A")
        .when(F.col("event_type") == "signup", " NaT ")
        .when(F.col("event_type") == "view", "soon")
        .when(F.col("event_type") == "click", F.concat(F.lit("  "), ts.cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.element_at(F.array(*[F.lit(text) for text, _ in ZONES]), (F.col("event_id") % len(ZONES) + 1).cast("int"))))
    )
    return events.select("event_id", posted.alias("posted_time"), F.to_date(ts).cast("string").alias("date"))


@query(
    "text_to_timestamp",
    f"""WITH {DATED} SELECT t.event_id,
      CASE event_type WHEN 'click' THEN CAST(ts AS VARCHAR)
        WHEN 'purchase' THEN CAST(date_trunc('second', ts) - to_hours([{_ZONE_HOURS}][t.event_id % 7 + 1]) AS VARCHAR) END AS posted_time,
      "date" || ' 00:00:00' AS "date"
    FROM typed t JOIN events e ON e.event_id = t.event_id""",
)
def text_to_timestamp(spark, folder):
    rows = ops.to_timestamps(_dated(spark, folder))
    return rows.select("event_id", F.col("posted_time").cast("string").alias("posted_time"), F.col("date").cast("string").alias("date"))


@query(
    "timestamp_report",
    """SELECT 'posted_time' AS column_name, count(*) AS n_before, count(*) FILTER (WHERE event_type = 'click' OR event_type = 'purchase' AND event_id % 7 <> 6) AS n_converted,
      count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase') OR event_type = 'purchase' AND event_id % 7 = 6) AS n_lost FROM events
    UNION ALL SELECT 'date', count(*), count(*), 0 FROM events""",
)
def timestamp_report(spark, folder):
    return ops.timestamp_report(_dated(spark, folder))


@query("calendar_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def calendar_dates(spark, folder):
    return table(spark, folder, "events").select("event_id", dates.date_text("ts").alias("date"))


@query(
    "week_and_day_buckets",
    """SELECT CAST(CAST(date_trunc('week', ts) AS DATE) + 6 AS VARCHAR) AS week_ending, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
      count(*) AS n FROM events GROUP BY ALL""",
)
def week_and_day_buckets(spark, folder):
    keys = [dates.week_ending("ts").cast("string").alias("week_ending"), F.to_date("ts").cast("string").alias("day")]
    return table(spark, folder, "events").groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "chart_ready_rows",
    RAW + """SELECT user_name, content AS review, score AS rating, thumbs_up, CAST(CAST(review_ts AS DATE) AS VARCHAR) AS date, bank
    FROM reviews WHERE review_ts IS NOT NULL AND content IS NOT NULL""",
)
def chart_ready_rows(spark, folder):
    rows = reviews(spark, folder).select(
        "user_name",
        F.col("content").alias("review"),
        F.col("score").alias("rating"),
        "thumbs_up",
        F.to_date("review_ts").cast("string").alias("date"),
        "bank",
    )
    ready = ops.prepare_for_charts(rows, ["user_name", "review", "rating", "thumbs_up", "date", "bank"])
    return ready.withColumn("date", F.to_date("date").cast("string"))


@query(
    "clean_reviews",
    f"WITH {CLEANED_SQL} SELECT review_id, review, rating, date, bank, source FROM cleaned",
)
def clean_reviews(spark, folder):
    return cleaned(spark, folder).drop("review_ts")
