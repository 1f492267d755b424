"""Files, landing pages and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, REVIEWS_SQL, cleaned, labelled, reviews, KNOWN_BANKS
from catalogue.text import THEMED
from revlens import schemas
from revlens.plans.ingest import ingest_folder
from revlens.session import fresh_path
from revlens.sources import files, landing

RAW = f"WITH {REVIEWS_SQL} "
CLEANED = f"WITH {CLEANED_SQL} "


@query("csv_round_trip", RAW + "SELECT review_id, lang, bank, content, score, CAST(review_ts AS VARCHAR) AS posted, thumbs_up FROM reviews")
def csv_round_trip(spark, folder):
    rows = reviews(spark, folder).drop("user_name")
    path = fresh_path(spark, "csv")
    files.write_csv(rows, path)
    back = files.load(spark, path, "csv", schema=rows.schema)
    return back.withColumn("review_ts", F.col("review_ts").cast("string")).withColumnRenamed("review_ts", "posted")


@query("csv_with_lists", THEMED + "SELECT review_id, bank, string_agg(theme, '|' ORDER BY theme) AS themes FROM themed GROUP BY review_id, bank")
def csv_with_lists(spark, folder):
    path = fresh_path(spark, "csv-lists")
    files.write_csv(labelled(spark, folder).select("review_id", "bank", "themes"), path)
    back = files.text_as_lists(files.read_csv(spark, path, "review_id bigint, bank string, themes string"), ["themes"])
    return back.withColumn("themes", F.array_join("themes", "|"))


@query("csv_inferred_types", "SELECT event_id, user_id, event_type, value FROM events")
def csv_inferred_types(spark, folder):
    path = fresh_path(spark, "csv-inferred")
    files.write_csv(table(spark, folder, "events").select("event_id", "user_id", "event_type", "value"), path)
    back = files.load(spark, path)
    return back.select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "value")


@query("parquet_source", "SELECT event_id, event_type, value FROM events WHERE value > 20")
def parquet_source(spark, folder):
    rows = files.read_parquet(spark, f"{folder}/events.parquet", schemas.EVENTS)
    return rows.where("value > 20").select("event_id", "event_type", "value")


@query("load_by_format", "SELECT doc_id, lang, source FROM documents")
def load_by_format(spark, folder):
    return files.load(spark, "documents.parquet", "parquet", base_path=folder).select("doc_id", "lang", "source")


@query(
    "newest_reviews_per_bank",
    RAW + """SELECT review_id, bank, score FROM (
      SELECT *, row_number() OVER (PARTITION BY bank ORDER BY review_ts DESC, review_id) AS rn FROM reviews) WHERE rn <= 20""",
)
def newest_reviews_per_bank(spark, folder):
    return landing.newest_reviews(reviews(spark, folder), 20).select("review_id", "bank", "score")


@query(
    "ingest_all_banks",
    RAW + """, one AS (SELECT *, row_number() OVER (PARTITION BY bank, content, CAST(review_ts AS DATE) ORDER BY review_ts DESC, review_id) AS dup FROM reviews)
    SELECT review_id, bank, content AS review, score AS rating, strftime(review_ts, '%Y-%m-%d') AS date, 'Google Play' AS source
    FROM one WHERE dup = 1 AND content IS NOT NULL AND score IS NOT NULL""",
)
def ingest_all_banks(spark, folder):
    landed = fresh_path(spark, "landing")
    reviews(spark, folder).select(*schemas.RAW_REVIEWS.fieldNames()).write.parquet(landed)
    done = ingest_folder(spark, landed, _expected(spark, folder), fresh_path(spark, "ingest"))
    return done.cleaned.select("review_id", "bank", "review", "rating", "date", "source")


@query("one_bank_of_partitioned_table", CLEANED + "SELECT review_id, review, rating FROM cleaned WHERE bank = 'src4'")
def one_bank_of_partitioned_table(spark, folder):
    path = fresh_path(spark, "by-bank")
    files.write_per_bank(cleaned(spark, folder), path)
    return spark.read.parquet(path).where("bank = 'src4'").select("review_id", "review", "rating")


def _expected(spark, folder):
    """The banks a run expects: those of the documents and one that never had a review."""
    sources = table(spark, folder, "documents").select(F.col("source").alias("name")).distinct()
    return sources.unionByName(spark.createDataFrame([("src-none",)], T.StructType([T.StructField("name", T.StringType())])))


@query(
    "volume_check",
    CLEANED + """SELECT b.bank, count(c.review_id) AS n, 40 AS min_required, count(c.review_id) >= 40 AS ok
    FROM (SELECT DISTINCT source AS bank FROM documents UNION ALL SELECT 'src-none') b LEFT JOIN cleaned c ON c.bank = b.bank GROUP BY b.bank""",
)
def volume_check(spark, folder):
    return landing.volume_check(cleaned(spark, folder), _expected(spark, folder), 40)


@query(
    "combined_tables",
    RAW + """SELECT review_id, bank, content, NULL AS turn FROM reviews
    UNION ALL SELECT conv_id, NULL, text, turn FROM conversations""",
)
def combined_tables(spark, folder):
    talks = table(spark, folder, "conversations").select(F.col("conv_id").alias("review_id"), F.col("text").alias("content"), "turn")
    return landing.combine([reviews(spark, folder).select("review_id", "bank", "content"), talks])


@query("apps_to_banks", "SELECT doc_id AS review_id, source AS app_id, 'Bank of ' || source AS bank FROM documents WHERE source IN (" + ", ".join(f"'{b}'" for b in KNOWN_BANKS) + ")")
def apps_to_banks(spark, folder):
    raw = table(spark, folder, "documents").select(F.col("doc_id").alias("review_id"), F.col("source").alias("app_id"))
    return landing.with_bank_names(raw, {app: f"Bank of {app}" for app in KNOWN_BANKS})


@query("rows_of_unknown_apps", "SELECT doc_id AS review_id, source AS app_id FROM documents WHERE source IS NULL OR source NOT IN (" + ", ".join(f"'{b}'" for b in KNOWN_BANKS) + ")")
def rows_of_unknown_apps(spark, folder):
    raw = table(spark, folder, "documents").select(F.col("doc_id").alias("review_id"), F.col("source").alias("app_id"))
    return landing.of_unknown_apps(raw, {app: f"Bank of {app}" for app in KNOWN_BANKS}).select("review_id", "app_id")


DAMAGED = "CASE event_id % 10 WHEN 3 THEN 'n/a' ELSE CAST(user_id AS STRING) END"


@query(
    "csv_rejects",
    f"""SELECT event_id % 10 IN (3, 7) AS rejected,
      CASE WHEN event_id % 10 = 7 THEN event_id || ',' || user_id ELSE event_id || ',' || {DAMAGED} || ',' || event_type END AS record FROM events""",
)
def csv_rejects(spark, folder):
    events = table(spark, folder, "events")
    fields = F.when(F.col("event_id") % 10 == 7, F.concat_ws(",", "event_id", "user_id")).otherwise(F.concat_ws(",", "event_id", F.expr(DAMAGED), "event_type"))
    path = fresh_path(spark, "csv-damaged")
    events.select(fields.alias("value")).write.text(path)
    rows, rejects = files.read_csv_with_rejects(spark, path, "event_id bigint, user_id bigint, event_type string", header=False)
    whole = rows.select(F.lit(False).alias("rejected"), F.concat_ws(",", "event_id", "user_id", "event_type").alias("record"))
    return whole.unionByName(rejects.select(F.lit(True).alias("rejected"), "record"))
