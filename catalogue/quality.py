"""Filters, duplicates and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, LABELLED_SQL, REVIEWS_SQL, cleaned, labelled, reviews
from revlens.functions.text import is_blank
from revlens.functions.vocab import INVALID_MARKERS
from revlens.operators import profile, rows as ops
from revlens.session import stage

RAW = f"WITH {REVIEWS_SQL} "
LABELLED = f"WITH {LABELLED_SQL} "
MARKERS = ", ".join(f"'{m}'" for m in ("", *INVALID_MARKERS))


@query("equality_filter", LABELLED + "SELECT review_id, rating FROM labelled WHERE bank = 'src2' AND sentiment_label = 'negative'")
def equality_filter(spark, folder):
    rows = labelled(spark, folder).where((F.col("bank") == "src2") & (F.col("sentiment_label") == "negative"))
    return rows.select("review_id", "rating")


@query("drop_missing_rows", RAW + "SELECT review_id, bank, score FROM reviews WHERE content IS NOT NULL AND score IS NOT NULL")
def drop_missing_rows(spark, folder):
    return ops.drop_missing(reviews(spark, folder), ["content", "score", "absent"]).select("review_id", "bank", "score")


@query("scored_rows_only", LABELLED + "SELECT review_id, bank, sentiment_label FROM labelled WHERE sentiment_label IS NOT NULL")
def scored_rows_only(spark, folder):
    rows = labelled(spark, folder).withColumn("themes", F.to_json("themes")).fillna("", ["sentiment_label"])
    return ops.scored_only(rows).select("review_id", "bank", "sentiment_label")


@query("drop_blank_text", RAW + r"SELECT review_id, bank FROM reviews WHERE regexp_replace(content, '^\s+|\s+$', '', 'g') <> ''")
def drop_blank_text(spark, folder):
    return ops.drop_blank_text(reviews(spark, folder), "content").select("review_id", "bank")


@query(
    "negative_or_low_rating",
    LABELLED + "SELECT review_id, rating, sentiment_label FROM labelled WHERE sentiment_label = 'negative' OR rating < 3 ORDER BY rating, review_id",
)
def negative_or_low_rating(spark, folder):
    rows = labelled(spark, folder).where((F.col("sentiment_label") == "negative") | (F.col("rating") < 3))
    return rows.select("review_id", "rating", "sentiment_label").orderBy("rating", "review_id")


@query(
    "row_loss_report",
    RAW + """SELECT 'has text' AS step, count(*) AS n_before, count(content) AS n_after, count(*) - count(content) AS n_dropped FROM reviews
    UNION ALL SELECT 'has rating', count(content), count(*) FILTER (WHERE content IS NOT NULL AND score IS NOT NULL),
      count(content) - count(*) FILTER (WHERE content IS NOT NULL AND score IS NOT NULL) FROM reviews
    UNION ALL SELECT 'not blank', count(*) FILTER (WHERE content IS NOT NULL AND score IS NOT NULL),
      count(*) FILTER (WHERE trim(content) <> '' AND score IS NOT NULL),
      count(*) FILTER (WHERE trim(content) = '' AND score IS NOT NULL) FROM reviews""",
)
def row_loss_report(spark, folder):
    steps = {"has text": F.col("content").isNotNull(), "has rating": F.col("score").isNotNull(), "not blank": ~is_blank("content")}
    return ops.step_report(reviews(spark, folder), steps)


FULL = "bank, content, score, CAST(review_ts AS VARCHAR) AS posted"


def _without_id(spark, folder):
    return reviews(spark, folder).select("bank", "content", "score", F.col("review_ts").cast("string").alias("posted"))


@query("duplicate_count", RAW + f"SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM (SELECT {FULL} FROM reviews) GROUP BY bank, content, score, posted)")
def duplicate_count(spark, folder):
    return ops.duplicate_count(_without_id(spark, folder))


@query(
    "duplicate_rows",
    RAW + f"""SELECT bank, content, score, posted FROM (
      SELECT *, row_number() OVER (PARTITION BY bank, content, score, posted) AS rn FROM (SELECT {FULL} FROM reviews)) WHERE rn > 1""",
)
def duplicate_rows(spark, folder):
    return ops.duplicate_rows(_without_id(spark, folder), "first")


@query(
    "duplicate_rows_all",
    RAW + f"""SELECT bank, content, score, posted FROM (
      SELECT *, count(*) OVER (PARTITION BY bank, content, score, posted) AS n FROM (SELECT {FULL} FROM reviews)) WHERE n > 1""",
)
def duplicate_rows_all(spark, folder):
    return ops.duplicate_rows(_without_id(spark, folder), False)


@query("drop_duplicate_rows", RAW + f"SELECT DISTINCT {FULL} FROM reviews")
def drop_duplicate_rows(spark, folder):
    return ops.drop_duplicate_rows(_without_id(spark, folder), "last")


@query("unrepeated_rows", RAW + f"SELECT bank, content, score, posted FROM (SELECT {FULL} FROM reviews) GROUP BY ALL HAVING count(*) = 1")
def unrepeated_rows(spark, folder):
    return ops.drop_duplicate_rows(_without_id(spark, folder), False)


@query(
    "event_type_repeats",
    """SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn FROM events) WHERE rn > 1""",
)
def event_type_repeats(spark, folder):
    keys = table(spark, folder, "events").select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"))
    return ops.duplicate_rows(keys, "last")


def _missing_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct FROM {source}"
        for c in columns
    )


MISSING = _missing_sql("reviews", ["review_id", "lang", "bank", "user_name", "content", "score", "review_ts", "thumbs_up"])


@query("missing_summary", RAW + MISSING)
def missing_summary(spark, folder):
    summary = profile.missing_summary(reviews(spark, folder)).orderBy(F.desc("n_missing"), "column_name")
    return summary.select("column_name", "n_missing", F.round("pct", 6).alias("pct"))


@query("missing_above_threshold", RAW + f"SELECT * FROM ({MISSING}) WHERE pct > 2")
def missing_above_threshold(spark, folder):
    found = profile.missing_above(reviews(spark, folder), 2.0).orderBy(F.desc("n_missing"), "column_name")
    return found.select("column_name", "n_missing", F.round("pct", 6).alias("pct"))


@query(
    "percent_text",
    RAW + "SELECT bank, printf('%.2f%%', 100.0 * count(content) / count(*)) AS filled FROM reviews GROUP BY bank",
)
def percent_text(spark, folder):
    from revlens.functions.text import percent_text as as_text

    share = 100.0 * F.count("content") / F.count("*")
    return reviews(spark, folder).groupBy("bank").agg(as_text(share).alias("filled"))


INVALID = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, review_id, {c} AS value FROM reviews WHERE trim({c}) IN ({MARKERS})" for c in ("lang", "bank", "user_name", "content")
)


@query("invalid_values", RAW + f"SELECT column_name, count(*) AS n_invalid FROM ({INVALID}) GROUP BY ALL")
def invalid_values(spark, folder):
    return profile.invalid_values(reviews(spark, folder))


@query(
    "invalid_examples",
    RAW + f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY review_id) AS INT) AS rank FROM ({INVALID})) WHERE rank <= 5",
)
def invalid_examples(spark, folder):
    return profile.invalid_examples(reviews(spark, folder), "review_id")


NUMBERS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


@query(
    "number_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        CAST(min({c}) AS DOUBLE) AS min_value, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS q1, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS median,
        round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS q3, CAST(max({c}) AS DOUBLE) AS max_value FROM lineitem"""
        for c in NUMBERS
    ),
)
def number_profile(spark, folder):
    found = profile.number_profile(table(spark, folder, "lineitem").select(*NUMBERS))
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "q1", "median", "q3")]
    return found.select("column_name", "n", *rounded, "min_value", "max_value")


TEXTS = ["lang", "bank", "user_name", "content"]


@query(
    "text_profile",
    RAW + " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS column_name, CAST(sum(hits) OVER () AS BIGINT) AS n, count(*) OVER () AS n_distinct, {c} AS top, hits AS freq
        FROM (SELECT {c}, count(*) AS hits FROM reviews WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY hits DESC, top LIMIT 1)"""
        for c in TEXTS
    ),
)
def text_profile(spark, folder):
    return profile.text_profile(reviews(spark, folder))


SKETCHED = ["event_id", "user_id", "event_type", "value"]
EVENT_COLUMNS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query(
    "column_info",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS n_values FROM events" for c, t in EVENT_COLUMNS.items()),
)
def column_info(spark, folder):
    return profile.column_info(table(spark, folder, "events"))


@query(
    "distinct_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM events" for c in EVENT_COLUMNS),
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(table(spark, folder, "events")).orderBy(F.desc("n_distinct"), "column_name")


def _in_bounds(span):
    return " UNION ALL ".join(f"SELECT '{name}' AS span, '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS within_bounds FROM events WHERE {where}" for name, where in span for c in SKETCHED)


@query("distinct_counts_by_sketch", _in_bounds([("all", "true"), ("first ten days", "CAST(ts AS DATE) < (SELECT CAST(min(ts) AS DATE) + 10 FROM events)")]))
def distinct_counts_by_sketch(spark, folder):
    """Sketches kept per day, merged for two spans, beside the exact counts: whether each estimate is within four deviations."""
    events = table(spark, folder, "events")
    daily = stage(profile.distinct_sketches(events, F.to_date("ts"), SKETCHED), "sketches")
    first = events.agg(F.date_add(F.to_date(F.min("ts")), 10)).scalar()
    spans = {"all": (F.lit(True), F.lit(True)), "first ten days": (F.col("part") < first, F.to_date("ts") < first)}
    out = None
    for name, (parts, rows) in spans.items():
        both = profile.distinct_over(daily.where(parts)).join(profile.distinct_counts(events.where(rows).select(*SKETCHED)), "column_name")
        error = 4 * 1.04 / 2 ** (profile.SKETCH_LG / 2)
        near = F.abs(F.col("n_estimated") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), F.col("n_distinct") * error)
        one = both.select(F.lit(name).alias("span"), "column_name", "n_distinct", near.alias("within_bounds"))
        out = one if out is None else out.union(one)
    return out


@query("table_shape", RAW + "SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns FROM reviews")
def table_shape(spark, folder):
    return profile.table_shape(reviews(spark, folder))


@query("first_rows", RAW + "SELECT review_id, bank, score FROM reviews ORDER BY review_id LIMIT 5")
def first_rows(spark, folder):
    return ops.head(reviews(spark, folder), "review_id").select("review_id", "bank", "score")


@query("last_rows", RAW + "SELECT review_id, bank, score FROM reviews ORDER BY review_id DESC LIMIT 5")
def last_rows(spark, folder):
    return ops.tail(reviews(spark, folder), "review_id").select("review_id", "bank", "score")


@query(
    "random_sample",
    f"WITH {CLEANED_SQL} SELECT review_id, bank, rating FROM cleaned ORDER BY md5('7:' || review_id), review_id LIMIT 10",
)
def random_sample(spark, folder):
    return ops.sample_rows(cleaned(spark, folder), "review_id", 10, seed=7).select("review_id", "bank", "rating")


@query("sorted_by_rating", f"WITH {CLEANED_SQL} SELECT review_id, rating FROM cleaned ORDER BY rating, review_id")
def sorted_by_rating(spark, folder):
    return cleaned(spark, folder).select("review_id", "rating").orderBy("rating", "review_id")


@query("distinct_banks", RAW + "SELECT DISTINCT bank FROM reviews")
def distinct_banks(spark, folder):
    return reviews(spark, folder).select("bank").distinct()
