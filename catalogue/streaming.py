"""Streaming jobs run to the end of the given tables and read back."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import functions as F

from catalogue.lexicon_sql import compound_ctes
from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, _RULES_SQL, cleaned
from catalogue.sentiment import model_ctes, score_ctes
from revlens import schemas
from revlens.functions.vocab import NO_THEME
from revlens.operators.sentiment import label_from_rating, train_word_model
from revlens.operators.warehouse import review_key
from revlens.session import fresh_path, stage
from revlens.sources.warehouse import read_facts
from revlens.streaming import jobs


DELAY = timedelta(days=7)


def _documents(spark, folder):
    """The documents as they land: one file, or a folder of files, which a pattern over names of files would not see."""
    return jobs.read_landing(spark, f"{folder}/{{documents.parquet}}", schemas.DOCUMENTS)


def _stretches(first, last):
    """The bounds between six or more stretches of time, none longer than the watermarks' delay."""
    n = max(6, math.ceil((last - first) / DELAY))
    return [first + (last - first) * i / n for i in range(1, n)]


def _events(spark, folder):
    """The events as they land: a load for each stretch of time, a file to a micro-batch.

    A load may come as several files in any order; its stretch is no longer than the delay, so that no file is late for another.
    """
    landed, events = fresh_path(spark, "landed-events"), table(spark, folder, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    bounds = _stretches(first, last)
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        later, earlier = F.lit(True) if low is None else F.col("ts") >= low, F.lit(True) if high is None else F.col("ts") < high
        events.where(later & earlier).write.mode("append").parquet(landed)
    # Watermarks need a time-zoned type; the table's times are UTC.
    events = jobs.read_landing(spark, landed, schemas.EVENTS, per_batch=1).withColumn("day", F.to_date("ts").cast("string"))
    return events.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


def _finish(spark, start, name):
    path = fresh_path(spark, name)
    start(path, fresh_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_model_scores",
    f"""WITH {CLEANED_SQL}, {model_ctes('cleaned', 'review', 'rating')}, {score_ctes('documents', 'doc_id', 'text')}
    SELECT id AS doc_id, label AS sentiment_label, round(CAST(score AS DOUBLE), 6) AS sentiment_score FROM predicted""",
)
def stream_model_scores(spark, folder):
    rated = cleaned(spark, folder).withColumn("label", label_from_rating("rating"))
    model = stage(train_word_model(rated, "review", "label"), "model")
    rows = _documents(spark, folder).select("doc_id", "text")
    scores = _finish(spark, lambda path, checkpoint: jobs.score_with_model(rows, model, "doc_id", "text", path, checkpoint, keep=["doc_id"]), "scored")
    return scores.select("doc_id", "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score"))


@query("stream_ingest", "SELECT doc_id, lang, source, md5(text) AS text_hash FROM documents")
def stream_ingest(spark, folder):
    rows = _documents(spark, folder).select("doc_id", "lang", "source", F.md5("text").alias("text_hash"))
    return _finish(spark, lambda path, checkpoint: jobs.append_stream(rows, path, checkpoint), "ingested")


@query("stream_first_arrivals", "SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def stream_first_arrivals(spark, folder):
    first = jobs.first_arrivals(_events(spark, folder), ["user_id", "event_type", "day"], "ts").select("user_id", "event_type", "day")
    return _finish(spark, lambda path, checkpoint: jobs.append_stream(first, path, checkpoint), "first")


@query(
    "stream_weekly_counts",
    """SELECT CAST(CAST(date_trunc('week', ts) AS DATE) + 6 AS VARCHAR) AS week_ending, event_type, count(*) AS count FROM events
    WHERE date_trunc('week', ts) + INTERVAL 14 DAY <= (SELECT max(ts) FROM events) GROUP BY ALL""",
)
def stream_weekly_counts(spark, folder):
    """Weeks that are over and can get no more rows: each is written once, a week after its end."""
    counts = jobs.weekly_counts(_events(spark, folder), "ts", "event_type")
    weeks = _finish(spark, lambda path, checkpoint: jobs.append_stream(counts, path, checkpoint), "weekly")
    return weeks.withColumn("week_ending", F.col("week_ending").cast("string"))


@query(
    "stream_weekly_counts_so_far",
    """SELECT CAST(CAST(date_trunc('week', ts) AS DATE) + 6 AS VARCHAR) AS week_ending, event_type, count(*) AS count FROM events GROUP BY ALL""",
)
def stream_weekly_counts_so_far(spark, folder):
    """All weeks, the open ones with what has come until now: the table is written anew after each batch."""
    counts = jobs.weekly_counts(_events(spark, folder), "ts", "event_type")
    path = fresh_path(spark, "weekly-so-far")
    jobs.replace_table(counts, path, fresh_path(spark, "weekly-so-far-checkpoint")).awaitTermination()
    return jobs.read_table(spark, path).withColumn("week_ending", F.col("week_ending").cast("string"))


@query("stream_fact_load", "SELECT DISTINCT sha256('=' || source || chr(31) || '=' || text) AS id, source AS bank FROM documents")
def stream_fact_load(spark, folder):
    def to_facts(batch):
        return batch.select(review_key("source", "text").alias("id"), F.col("source").alias("bank"))

    def start(path, checkpoint):
        # The second run has no memory of the first and reads everything again.
        jobs.load_facts(_documents(spark, folder), to_facts, path, f"{checkpoint}/1").awaitTermination()
        return jobs.load_facts(_documents(spark, folder), to_facts, path, f"{checkpoint}/2")

    path = fresh_path(spark, "facts")
    start(path, fresh_path(spark, "facts-checkpoint")).awaitTermination()
    return read_facts(spark, path)


@query(
    "stream_scores",
    f"""WITH {compound_ctes('documents', 'doc_id', 'text')}, rules(part, theme) AS (VALUES {_RULES_SQL}),
      found AS (SELECT DISTINCT d.doc_id, r.theme FROM documents d JOIN rules r ON contains(lower(d.text), r.part)),
      listed AS (SELECT doc_id, string_agg(theme, '|' ORDER BY theme) AS themes FROM found GROUP BY doc_id)
    SELECT c.id AS doc_id, round(c.compound, 6) AS compound, coalesce(l.themes, '{NO_THEME}') AS themes FROM compounds c LEFT JOIN listed l ON l.doc_id = c.id""",
)
def stream_scores(spark, folder):
    scored = jobs.score_rows(_documents(spark, folder), "text")
    rows = scored.select("doc_id", F.round("compound", 6).alias("compound"), F.array_join("themes", "|").alias("themes"))
    return _finish(spark, lambda path, checkpoint: jobs.append_stream(rows, path, checkpoint), "scores")
