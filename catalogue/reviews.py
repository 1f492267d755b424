"""Review tables derived from the given tables, in Spark and as SQL for the check.

Each document is one review. Its bank is the document's source; the ten events that share its
number give time, user and likes; its labels give the rating. Documents hold neither emoji nor
theme words, so an opening phrase is put in front of the whole text; it depends on the text's length,
so copies stay copies. Labelled-toxic reviews are taken down (no text), reviews with many error or
sign-up events exported badly, reviews with many clicks were submitted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalogue.registry import table
from revlens.operators.lexicon import add_compound
from revlens.operators.sentiment import label_from_rating
from revlens.operators.themes import themes_of_text
from revlens.functions.vocab import NO_THEME, THEME_RULES
from revlens.sources.landing import clean_reviews

OPENERS = (
    "Login fails and password reset is broken 😡 ",
    "Love the new design 😍 great interface ",
    "App keeps crashing!! very slow 😭 ",
    "Good app, best support ever 👍 ",
    "Please add this feature and update soon 🙏 ",
    "It does not work right, bad update ☹️ ",
    "Slow transactions and poor support response. ",
    "Great app! Love the features 😀😀 ",
    "Cannot login, so frustrating 😤 ",
    "ok ",
    "Not bad, simple interface 🙂 but it's slow? ",
    "Worst update, it crashed again 🤬 ",
)
KNOWN_BANKS = tuple(f"src{i}" for i in range(17))
MANY = 5


def _count(event_type: str) -> Column:
    return F.count(F.when(F.col("event_type") == event_type, 1))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews: review_id, lang, bank, user_name, content, score, review_ts, thumbs_up."""
    signals = (
        table(spark, folder, "events")
        .groupBy(F.expr("event_id div 10").alias("doc_id"))
        .agg(
            F.min("ts").alias("review_ts"),
            F.floor(F.max("value")).cast("int").alias("thumbs_up"),
            F.min("user_id").alias("user_id"),
            *[_count(t).alias(f"n_{t}") for t in ("click", "error", "purchase", "signup", "view")],
        )
    )
    joined = table(spark, folder, "documents").join(signals, "doc_id", "left").join(table(spark, folder, "labels"), "doc_id", "left")
    n = {t: F.coalesce(F.col(f"n_{t}"), F.lit(0)) for t in ("click", "error", "purchase", "signup", "view")}
    opener = F.element_at(F.array(*[F.lit(o) for o in OPENERS]), (F.col("n_chars") % len(OPENERS) + 1).cast("int"))
    content = (
        F.when(F.col("toxic") == 1, None)
        .when(n["error"] >= MANY, "N/A")
        .when(n["signup"] >= MANY, "   ")
        .otherwise(F.concat(opener, F.col("text")))
    )
    score = (
        F.when(n["purchase"] >= MANY, None)
        .when(F.col("quality") == 1, 4 + n["click"] % 2)
        .when(F.col("quality") == 0, 1 + n["click"] % 2)
        .otherwise(1 + n["view"] % 5)
    )
    own_id = F.col("doc_id")
    ids = F.when(n["click"] >= MANY, F.array(own_id, -own_id - 1)).otherwise(F.array(own_id))
    return joined.select(
        F.explode(ids).alias("review_id"),
        "lang",
        F.col("source").alias("bank"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        content.alias("content"),
        score.cast("int").alias("score"),
        "review_ts",
        "thumbs_up",
    )


def _openers_sql() -> str:
    whens = "\n".join(f"WHEN {i} THEN '{o.replace(chr(39), chr(39) * 2)}'" for i, o in enumerate(OPENERS))
    return f"CASE n_chars % {len(OPENERS)}\n{whens} END"


def _count_sql(event_type: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{event_type}') AS n_{event_type}"


REVIEWS_SQL = f"""
signals AS (
  SELECT CAST(floor(event_id / 10) AS BIGINT) AS doc_id, min(ts) AS review_ts,
    CAST(floor(max(value)) AS INT) AS thumbs_up, min(user_id) AS user_id,
    {_count_sql('click')}, {_count_sql('error')}, {_count_sql('purchase')}, {_count_sql('signup')}, {_count_sql('view')}
  FROM events GROUP BY 1
), submitted AS (
  SELECT d.doc_id AS review_id, d.lang, d.source AS bank, 'user' || s.user_id AS user_name,
    CASE WHEN l.toxic = 1 THEN NULL
         WHEN s.n_error >= {MANY} THEN 'N/A'
         WHEN s.n_signup >= {MANY} THEN '   '
         ELSE {_openers_sql()} || d.text END AS content,
    CAST(CASE WHEN s.n_purchase >= {MANY} THEN NULL
         WHEN l.quality = 1 THEN 4 + coalesce(s.n_click, 0) % 2
         WHEN l.quality = 0 THEN 1 + coalesce(s.n_click, 0) % 2
         ELSE 1 + coalesce(s.n_view, 0) % 5 END AS INT) AS score,
    s.review_ts, s.thumbs_up, s.n_click
  FROM documents d LEFT JOIN signals s ON s.doc_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
), reviews AS (
  SELECT review_id, lang, bank, user_name, content, score, review_ts, thumbs_up FROM submitted
  UNION ALL
  SELECT -review_id - 1, lang, bank, user_name, content, score, review_ts, thumbs_up FROM submitted WHERE n_click >= {MANY}
)"""


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """One row per bank, text and day, complete: review, rating, date, bank, source."""
    return clean_reviews(reviews(spark, folder))


CLEANED_SQL = (
    REVIEWS_SQL
    + """, cleaned AS (
  SELECT review_id, content AS review, score AS rating, strftime(review_ts, '%Y-%m-%d') AS date, bank,
    'Google Play' AS source, review_ts
  FROM (
    SELECT *, row_number() OVER (PARTITION BY bank, content, CAST(review_ts AS DATE) ORDER BY review_ts DESC, review_id) AS rn
    FROM reviews)
  WHERE rn = 1 AND content IS NOT NULL AND score IS NOT NULL
)"""
)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned reviews with a sentiment from their rating and themes from their text."""
    return cleaned(spark, folder).withColumns(
        {"sentiment_label": label_from_rating("rating"), "themes": themes_of_text("review")}
    )


_RULES_SQL = ", ".join(f"('{key}', '{theme}')" for key, theme in THEME_RULES.items())
LABELLED_SQL = (
    CLEANED_SQL
    + f""", labelled AS (
  SELECT *, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' END AS sentiment_label FROM cleaned
), rules(part, theme) AS (VALUES {_RULES_SQL}), matched AS (
  SELECT DISTINCT l.review_id, r.theme FROM labelled l JOIN rules r ON contains(lower(l.review), r.part)
), themed AS (
  SELECT l.*, coalesce(m.theme, '{NO_THEME}') AS theme FROM labelled l LEFT JOIN matched m ON m.review_id = l.review_id
)"""
)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled reviews with a score in [0, 1] from the lexicon."""
    rows = add_compound(labelled(spark, folder), "review")
    return rows.withColumn("sentiment_score", (F.col("compound") + 1) / 2)
