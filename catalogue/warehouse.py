"""The two-table warehouse: keys, loads, audits and the report extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from catalogue.reviews import KNOWN_BANKS, LABELLED_SQL, REVIEWS_SQL, labelled, reviews
from revlens.functions.text import squeeze
from revlens.operators import warehouse as ops
from revlens.operators.joins import spread_join
from revlens.session import fresh_path
from revlens.sources.warehouse import append_facts, read_facts

RAW = f"WITH {REVIEWS_SQL} "
LABELLED = f"WITH {LABELLED_SQL} "
STORED_BANKS = KNOWN_BANKS[:10]
LOADED = "2024-02-01 00:00:00"


def _names(values):
    return ", ".join(f"'{v}'" for v in values)


NUMBERED = f"""banks AS (
  SELECT name, row_number() OVER (ORDER BY name NOT IN ({_names(STORED_BANKS)}), left(md5(name), 2), name) AS id
  FROM (SELECT DISTINCT source AS name FROM documents WHERE source IN ({_names(KNOWN_BANKS)})))"""


def _bank_names(spark, folder, wanted):
    found = table(spark, folder, "documents").select(F.col("source").alias("name"))
    return found.where(F.col("name").isin(list(wanted)))


def _stored(spark, folder):
    names = _bank_names(spark, folder, STORED_BANKS).distinct()
    return ops.dense_ids(names, "name").select("id", "name", F.lit(LOADED).cast("timestamp").alias("created_at"))


def _banks(spark, folder):
    return ops.upsert_banks(_stored(spark, folder), _bank_names(spark, folder, KNOWN_BANKS), F.lit(LOADED).cast("timestamp"))


def _facts(spark, folder):
    rows = labelled(spark, folder).select(
        "bank",
        F.col("review").alias("review_text"),
        "rating",
        "date",
        "source",
        squeeze("review").alias("cleaned_text"),
        "sentiment_label",
        (F.col("rating") / 5).alias("sentiment_score"),
        F.col("themes").alias("keywords"),
        "themes",
    )
    return ops.typed_facts(rows, F.lit(LOADED).cast("timestamp"))


FACT_ID = "sha256('=' || bank || chr(31) || '=' || review || chr(31) || coalesce('=' || date, '?') || chr(31) || coalesce('=' || rating, '?'))"
FACTS = f"""{LABELLED}, themes AS (SELECT review_id, CAST(to_json(list(theme ORDER BY theme)) AS VARCHAR) AS themes FROM themed GROUP BY review_id),
  facts AS (SELECT {FACT_ID} AS id, l.*, t.themes FROM labelled l JOIN themes t ON t.review_id = l.review_id), {NUMBERED} """


@query("bank_ids", f"WITH {NUMBERED} SELECT id, name FROM banks")
def bank_ids(spark, folder):
    return _banks(spark, folder).select("id", "name")


@query(
    "fact_ids",
    f"{FACTS} SELECT id, CAST(count(*) AS BIGINT) AS n FROM facts GROUP BY id",
)
def fact_ids(spark, folder):
    return _facts(spark, folder).groupBy("id").agg(F.count("*").alias("n"))


@query(
    "typed_facts",
    f"""{FACTS} SELECT id, bank, review AS review_text, CAST(CAST(rating AS DECIMAL(2,1)) AS VARCHAR) AS rating, date AS review_date, source,
      trim(regexp_replace(review, '\\s+', ' ', 'g')) AS cleaned_text, sentiment_label, round(rating / 5, 6) AS sentiment_score, themes AS keywords, themes FROM facts""",
)
def typed_facts(spark, folder):
    rows = _facts(spark, folder).drop("created_at")
    return rows.withColumns(
        {
            "rating": F.col("rating").cast("string"),
            "review_date": F.col("review_date").cast("string"),
            "sentiment_score": F.round("sentiment_score", 6),
        }
    )


@query(
    "ratings_that_do_not_fit",
    RAW + "SELECT review_id, CASE WHEN thumbs_up < 10 THEN CAST(CAST(thumbs_up AS DECIMAL(2,1)) AS VARCHAR) END AS rating FROM reviews",
)
def ratings_that_do_not_fit(spark, folder):
    fitted = F.col("thumbs_up").cast("string").try_cast("decimal(2,1)").cast("string")
    return reviews(spark, folder).select("review_id", fitted.alias("rating"))


@query("facts_with_bank_ids", f"{FACTS} SELECT f.id, b.id AS bank_id FROM facts f JOIN banks b ON b.name = f.bank")
def facts_with_bank_ids(spark, folder):
    return ops.with_bank_ids(_facts(spark, folder), _banks(spark, folder)).select("id", "bank_id")


@query("reviews_of_known_banks", f"{FACTS} SELECT id, bank FROM facts WHERE bank IN (SELECT name FROM banks)")
def reviews_of_known_banks(spark, folder):
    return ops.known_banks(_facts(spark, folder), _banks(spark, folder)).select("id", "bank")


@query("reviews_of_unknown_banks", f"{FACTS} SELECT id, bank FROM facts WHERE bank NOT IN (SELECT name FROM banks)")
def reviews_of_unknown_banks(spark, folder):
    return ops.unknown_banks(_facts(spark, folder), _banks(spark, folder)).select("id", "bank")


def _broken(spark, folder):
    """Raw reviews against the few stored banks: missing texts, repeated ids, banks without a row."""
    ids = _banks(spark, folder).select(F.col("id").alias("bank_id"), F.col("name").alias("bank"))
    raw = reviews(spark, folder).select(
        F.coalesce(F.md5("content"), F.col("review_id").cast("string")).alias("id"), "bank", F.col("content").alias("review_text")
    )
    return spread_join(raw, ids, ["bank"], "left", spread_on="id").select("id", "bank_id", "review_text")


@query(
    "warehouse_audit",
    f"""{RAW}, {NUMBERED}, facts AS (SELECT coalesce(md5(content), CAST(review_id AS VARCHAR)) AS id, b.id AS bank_id, content FROM reviews r LEFT JOIN banks b ON b.name = r.bank)
    SELECT 'reviews.id primary key' AS rule, id AS key, count(*) AS n FROM facts GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT 'reviews.bank_id not null', 'bank_id', count(*) FROM facts WHERE bank_id IS NULL
    UNION ALL SELECT 'reviews.review_text not null', 'review_text', count(*) FROM facts WHERE content IS NULL
    UNION ALL SELECT 'reviews.bank_id foreign key', CAST(bank_id AS VARCHAR), count(*) FROM facts WHERE bank_id > {len(STORED_BANKS)} GROUP BY bank_id""",
)
def warehouse_audit(spark, folder):
    return ops.audit_warehouse(_stored(spark, folder), _broken(spark, folder))


@query(
    "reviews_after_bank_deletion",
    f"{FACTS} SELECT f.id, b.id AS bank_id FROM facts f JOIN banks b ON b.name = f.bank WHERE b.name NOT IN ('src2', 'src13')",
)
def reviews_after_bank_deletion(spark, folder):
    banks = _banks(spark, folder)
    facts = ops.with_bank_ids(_facts(spark, folder), banks)
    deleted = _bank_names(spark, folder, ["src2", "src13"]).distinct()
    return ops.without_banks(facts, banks, deleted)[1].select("id", "bank_id")


@query(
    "report_extract",
    f"""{FACTS} SELECT b.name AS bank_name, review AS review_text, CAST(CAST(rating AS DECIMAL(2,1)) AS VARCHAR) AS rating, date AS review_date,
      sentiment_label, themes AS keywords, themes FROM facts f JOIN banks b ON b.name = f.bank WHERE sentiment_label IS NOT NULL""",
)
def report_extract(spark, folder):
    banks = _banks(spark, folder)
    extract = ops.report_extract(ops.with_bank_ids(_facts(spark, folder), banks), banks)
    return extract.withColumns({"rating": F.col("rating").cast("string"), "review_date": F.col("review_date").cast("string")})


@query("facts_loaded_twice", f"{FACTS} SELECT DISTINCT id, bank, rating, themes FROM facts")
def facts_loaded_twice(spark, folder):
    path = fresh_path(spark, "facts")
    for _ in range(2):
        append_facts(_facts(spark, folder), path)
    stored = read_facts(spark, path)
    return stored.select("id", "bank", F.col("rating").cast("int").alias("rating"), "themes")
