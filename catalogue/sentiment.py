"""Sentiment, language, translation, and the whole scoring chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.lexicon_sql import compound_ctes, induced_ctes
from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, REVIEWS_SQL, cleaned, reviews
from catalogue.text import TOKEN, _WHENS, _emoji_sql, normal_ctes, term_ctes
from revlens.functions.text import split_words
from revlens.functions.vocab import LEXICON, NO_THEME
from revlens.operators import induction, language, sentiment
from revlens.operators.lexicon import add_compound, add_compound_from_table, sentiment_tokens
from revlens.plans.enrich import enrich_reviews, run_pipeline
from revlens.plans.explore import explore
from revlens.session import fresh_path, stage
from revlens.sources.files import report_export, text_as_lists, write_csv

RAW = f"WITH {REVIEWS_SQL} "
CLEANED = f"WITH {CLEANED_SQL} "
LANGUAGES = ("de", "en", "es", "fr")


@query("lexicon_scores", CLEANED + f", {compound_ctes('cleaned', 'review_id', 'review')} SELECT id AS review_id, round(compound, 6) AS compound FROM compounds")
def lexicon_scores(spark, folder):
    return add_compound(cleaned(spark, folder), "review").select("review_id", F.round("compound", 6).alias("compound"))


@query("lexicon_scores_by_table", CLEANED + f", {compound_ctes('cleaned', 'review_id', 'review')} SELECT id AS review_id, round(compound, 6) AS compound FROM compounds")
def lexicon_scores_by_table(spark, folder):
    words = spark.createDataFrame([(w, float(v)) for w, v in LEXICON.items()], "word string, valence double")
    return add_compound_from_table(cleaned(spark, folder), "review_id", "review", words).select("review_id", F.round("compound", 6).alias("compound"))


INDUCED = CLEANED + ", " + induced_ctes("cleaned", "review", induction.LEAST, induction.ROUNDS, induction.DAMPING, induction.FAINTEST)


@query("induced_lexicon", INDUCED + " SELECT w AS word, round(CAST(v AS DOUBLE), 6) AS valence FROM induced")
def induced_lexicon(spark, folder):
    return induction.induced_lexicon(cleaned(spark, folder), "review").withColumn("valence", F.round("valence", 6))


@query(
    "lexicon_scores_by_induction",
    INDUCED + f", {compound_ctes('cleaned', 'review_id', 'review', 'induced')} SELECT id AS review_id, round(compound, 6) AS compound FROM compounds",
)
def lexicon_scores_by_induction(spark, folder):
    # the words are read from the text once and written beside it
    rows = stage(cleaned(spark, folder).select("review_id", "review", F.array_join(sentiment_tokens("review"), " ").alias("words")), "cleaned-reviews")
    grown = induction.induced_lexicon(rows, "words", split=split_words)
    return add_compound_from_table(rows, "review_id", "review", grown, tokens=split_words("words")).select("review_id", F.round("compound", 6).alias("compound"))


def model_ctes(source: str, text: str, rating: str) -> str:
    """CTEs ending in `model(token, weight)`, trained on the rows of `source`."""
    return rf"""rated AS (SELECT {text} AS t, CASE WHEN {rating} >= 4 THEN 1 WHEN {rating} <= 2 THEN 0 END AS pos FROM {source}),
    known AS (SELECT * FROM rated WHERE pos IS NOT NULL),
    bag AS (SELECT pos, unnest(regexp_extract_all(lower(t), '{TOKEN}')) AS token FROM known),
    counts AS (SELECT token, count(*) FILTER (WHERE pos = 1) AS p, count(*) FILTER (WHERE pos = 0) AS n FROM bag GROUP BY token),
    model AS (SELECT token, ln((p + 1) / CAST((SELECT sum(p) + count(*) FROM counts) AS DOUBLE)) - ln((n + 1) / CAST((SELECT sum(n) + count(*) FROM counts) AS DOUBLE)) AS weight FROM counts
      UNION ALL SELECT '', ln(CAST(count(*) FILTER (WHERE pos = 1) + 1 AS DOUBLE) / (count(*) FILTER (WHERE pos = 0) + 1)) FROM known)"""


def score_ctes(source: str, row_id: str, text: str) -> str:
    """CTEs ending in `predicted(id, label, score)` for the rows of `source`."""
    return rf"""words AS (SELECT {row_id} AS id, unnest(regexp_extract_all(lower({text}), '{TOKEN}')) AS token FROM {source}),
    odds AS (SELECT w.id, sum(m.weight) AS o FROM words w JOIN model m ON m.token = w.token GROUP BY w.id),
    prior AS (SELECT weight AS w FROM model WHERE token = ''),
    margins AS (SELECT r.{row_id} AS id, coalesce(trim({text}), '') = '' OR o.o IS NULL AS blank, o.o + p.w AS d
      FROM {source} r JOIN prior p ON true LEFT JOIN odds o ON o.id = r.{row_id}),
    predicted AS (SELECT id, CASE WHEN blank THEN 'neutral' WHEN d >= 0 THEN 'positive' ELSE 'negative' END AS label,
      CASE WHEN blank THEN 0.0 ELSE 1 / (1 + exp(-abs(d))) END AS score FROM margins)"""


@query("word_model", CLEANED + f", {model_ctes('cleaned', 'review', 'rating')} SELECT token, round(weight, 6) AS weight FROM model")
def word_model(spark, folder):
    rows = cleaned(spark, folder).withColumn("label", sentiment.label_from_rating("rating"))
    return sentiment.train_word_model(rows, "review", "label").withColumn("weight", F.round("weight", 6))


@query(
    "model_sentiment",
    RAW + f", {model_ctes('reviews', 'content', 'score')}, {score_ctes('reviews', 'review_id', 'content')} SELECT id AS review_id, label AS sentiment_label, round(CAST(score AS DOUBLE), 6) AS sentiment_score FROM predicted",
)
def model_sentiment(spark, folder):
    rows = reviews(spark, folder)
    rows = stage(rows.select("review_id", "content", "score"), "reviews")
    model = stage(sentiment.train_word_model(rows.withColumn("label", sentiment.label_from_rating("score")), "content", "label"), "model")
    scored = sentiment.add_sentiment(rows, "review_id", "content", model)
    return scored.select("review_id", "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score"))


@query(
    "batch_model_sentiment",
    RAW + """SELECT review_id, CASE WHEN coalesce(trim(content), '') = '' THEN 'neutral' WHEN contains(content, 'e') THEN 'positive' ELSE 'negative' END AS sentiment_label,
      CASE WHEN coalesce(trim(content), '') = '' THEN 0.0 ELSE round(length(content) / 1000.0, 6) END AS sentiment_score FROM reviews""",
)
def batch_model_sentiment(spark, folder):
    def load():
        # Stands in for a model: deterministic, so that SQL can check what reaches it.
        return lambda texts: [("POSITIVE" if "e" in t else "NEGATIVE", len(t) / 1000) for t in texts]

    scored = sentiment.add_model_sentiment(reviews(spark, folder), "content", load)
    return scored.select("review_id", "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score"))


def language_ctes(train: str, lang: str, train_text: str, source: str, row_id: str, text: str) -> str:
    """CTEs ending in `detected(id, detected_lang, lang_score)` for the rows of `source`."""
    grams = r"unnest(regexp_extract_all(lower({t}), '\p{{L}}+'))"
    return rf"""train_words AS (SELECT {lang} AS lang, {grams.format(t=train_text)} AS w FROM {train}),
    train_grams AS (SELECT lang, substring(' ' || w || ' ', unnest(generate_series(1, length(w))), 3) AS gram FROM train_words),
    gram_counts AS (SELECT lang, gram, count(*) AS n FROM train_grams GROUP BY ALL),
    profiles AS (SELECT lang, gram, n FROM gram_counts),
    totals AS (SELECT lang, sum(n) AS total FROM profiles GROUP BY lang),
    every AS (SELECT g.gram, t.lang, t.total FROM (SELECT DISTINCT gram FROM profiles) g, totals t),
    logs AS (SELECT e.gram, e.lang, ln(CAST(coalesce(p.n, 0) + 1 AS DOUBLE) / (e.total + (SELECT count(DISTINCT gram) FROM profiles))) AS lp FROM every e LEFT JOIN profiles p ON p.lang = e.lang AND p.gram = e.gram),
    test_words AS (SELECT {row_id} AS id, {grams.format(t=text)} AS w FROM {source}),
    test_grams AS (SELECT id, substring(' ' || w || ' ', unnest(generate_series(1, length(w))), 3) AS gram FROM test_words),
    test_counts AS (SELECT id, gram, count(*) AS c FROM test_grams GROUP BY ALL),
    lang_scores AS (SELECT t.id, l.lang, sum(t.c * l.lp) / sum(t.c) AS score FROM test_counts t JOIN logs l ON l.gram = t.gram GROUP BY ALL),
    detected AS (SELECT id, lang AS detected_lang, score AS lang_score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS rn FROM lang_scores) WHERE rn = 1)"""


def _profiles(spark, folder):
    return stage(language.train_profiles(table(spark, folder, "documents"), "text", "lang", LANGUAGES), "profiles")


ON_DOCUMENTS = "WITH " + language_ctes("documents", "lang", "text", "documents", "doc_id", "text")
ON_REVIEWS = RAW + ", " + language_ctes("documents", "lang", "text", "reviews", "review_id", "content")


@query("language_profiles", ON_DOCUMENTS + " SELECT lang, gram, n FROM profiles")
def language_profiles(spark, folder):
    return _profiles(spark, folder)


@query(
    "detected_languages",
    ON_REVIEWS + " SELECT r.review_id, d.detected_lang, round(d.lang_score, 6) AS lang_score FROM reviews r LEFT JOIN detected d ON d.id = r.review_id",
)
def detected_languages(spark, folder):
    found = language.add_language(reviews(spark, folder), "review_id", "content", _profiles(spark, folder), LANGUAGES)
    return found.select("review_id", "detected_lang", F.round("lang_score", 6).alias("lang_score"))


@query("english_reviews", ON_REVIEWS + " SELECT r.review_id, r.bank FROM reviews r JOIN detected d ON d.id = r.review_id WHERE d.detected_lang = 'en'")
def english_reviews(spark, folder):
    kept = language.keep_language(reviews(spark, folder), "review_id", "content", _profiles(spark, folder), LANGUAGES)
    return kept.select("review_id", "bank")


@query(
    "translated_documents",
    ON_DOCUMENTS + """, memory AS (SELECT DISTINCT d.lang, d.text, 'translated: ' || upper(d.source) AS translation
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1),
      one AS (SELECT lang, text, min(translation) AS translation FROM memory GROUP BY lang, text)
    SELECT d.doc_id, CASE WHEN t.detected_lang <> 'en' THEN coalesce(m.translation, d.text) ELSE d.text END AS text
    FROM documents d LEFT JOIN detected t ON t.id = d.doc_id LEFT JOIN one m ON m.lang = t.detected_lang AND m.text = d.text""",
)
def translated_documents(spark, folder):
    documents = table(spark, folder, "documents")
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    memory = (
        documents.join(good, "doc_id")
        .groupBy("lang", "text")
        .agg(F.min(F.concat(F.lit("translated: "), F.upper("source"))).alias("translation"))
    )
    known = language.add_language(documents, "doc_id", "text", _profiles(spark, folder), LANGUAGES)
    return language.translate(known, "doc_id", "text", "detected_lang", memory).select("doc_id", "text")


CHAIN = (
    CLEANED
    + f""", worded AS (SELECT *, {_emoji_sql('review')} AS with_words FROM cleaned), {normal_ctes('worded', 'review_id', 'with_words')},
    prepared AS (SELECT c.*, n.cleaned_text FROM cleaned c JOIN normal n ON n.id = c.review_id WHERE n.cleaned_text <> ''),
    {model_ctes('prepared', 'cleaned_text', 'rating')}, {score_ctes('prepared', 'review_id', 'cleaned_text')},
    {term_ctes('prepared', 'review_id', 'cleaned_text')},
    k AS (SELECT id, string_agg(term, chr(10)) AS words, string_agg(term, '|' ORDER BY rank) AS keywords FROM tops WHERE rank <= 5 GROUP BY id),
    t AS (SELECT id, keywords, list_sort(list_distinct(list_filter([{_WHENS}], lambda x: x IS NOT NULL))) AS themes FROM k),
    chained AS (SELECT p.review_id, p.review AS review_text, p.rating, p.date, p.bank, p.source, p.cleaned_text, s.label AS sentiment_label, round(s.score, 6) AS sentiment_score,
      coalesce(t.keywords, '') AS keywords, CASE WHEN t.themes IS NULL OR len(t.themes) = 0 THEN '{NO_THEME}' ELSE array_to_string(t.themes, '|') END AS themes
      FROM prepared p JOIN predicted s ON s.id = p.review_id LEFT JOIN t ON t.id = p.review_id) """
)


def _chained(spark, folder):
    rows = enrich_reviews(cleaned(spark, folder).drop("review_ts"))
    return rows.withColumn("sentiment_score", F.round("sentiment_score", 6))


@query("scored_reviews", CHAIN + "SELECT * FROM chained")
def scored_reviews(spark, folder):
    rows = _chained(spark, folder)
    return rows.withColumns({c: F.array_join(c, "|") for c in ("keywords", "themes")})


@query("report_export", CHAIN + "SELECT review_text, bank, rating, sentiment_label, sentiment_score, themes FROM chained")
def exported_report(spark, folder):
    return report_export(_chained(spark, folder)).withColumn("themes", F.array_join("themes", "|"))


@query(
    "pipeline_on_files",
    f"""WITH plain AS (SELECT doc_id, text AS review, {_emoji_sql('text')} AS with_words FROM documents), {normal_ctes('plain', 'doc_id', 'with_words')},
    prepared AS (SELECT p.doc_id, p.review, n.cleaned_text FROM plain p JOIN normal n ON n.id = p.doc_id WHERE n.cleaned_text <> ''),
    {compound_ctes('prepared', 'doc_id', 'cleaned_text')}, {term_ctes('prepared', 'doc_id', 'cleaned_text')},
    k AS (SELECT id, string_agg(term, chr(10)) AS words, string_agg(term, '|' ORDER BY rank) AS keywords FROM tops WHERE rank <= 5 GROUP BY id),
    t AS (SELECT id, keywords, list_sort(list_distinct(list_filter([{_WHENS}], lambda x: x IS NOT NULL))) AS themes FROM k)
    SELECT p.doc_id, md5(p.cleaned_text) AS cleaned, CASE WHEN c.compound >= 0.05 THEN 'positive' WHEN c.compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
      CASE WHEN abs(c.compound) >= 0.05 THEN round(0.5 + abs(c.compound) / 2, 6) ELSE 0.0 END AS sentiment_score,
      coalesce(t.keywords, '') AS keywords, CASE WHEN t.themes IS NULL OR len(t.themes) = 0 THEN '{NO_THEME}' ELSE array_to_string(t.themes, '|') END AS themes
    FROM prepared p JOIN compounds c ON c.id = p.doc_id LEFT JOIN t ON t.id = p.doc_id""",
)
def pipeline_on_files(spark, folder):
    path = fresh_path(spark, "pipeline")
    write_csv(table(spark, folder, "documents").select("doc_id", F.col("text").alias("review")), f"{path}/in.csv")
    scored = text_as_lists(run_pipeline(spark, f"{path}/in.csv", f"{path}/out.csv"), ["keywords", "themes"])
    lists = [F.array_join(c, "|").alias(c) for c in ("keywords", "themes")]
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("cleaned_text").alias("cleaned"), "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score"), *lists)


@query(
    "explored_reviews",
    RAW + f""", whole AS (SELECT DISTINCT review_id, content, score, review_ts, thumbs_up FROM reviews WHERE content IS NOT NULL AND score IS NOT NULL),
      worded AS (SELECT *, {_emoji_sql('content')} AS with_words FROM whole), {language_ctes('documents', 'lang', 'text', 'worded', 'review_id', 'with_words')}
    SELECT w.with_words AS review, w.score AS rating, CAST(w.review_ts AS VARCHAR) AS date, w.thumbs_up AS likes, 'any' AS bank, 'Google Store' AS source
    FROM worded w JOIN detected d ON d.id = w.review_id WHERE d.detected_lang = 'en'""",
)
def explored_reviews(spark, folder):
    raw = reviews(spark, folder).select(
        F.col("review_id").alias("reviewId"), "content", "score", F.col("review_ts").cast("string").alias("at"), F.col("thumbs_up").alias("likes"), F.lit(None).cast("string").alias("userImage")
    )
    rows = explore(raw, "any", _profiles(spark, folder), LANGUAGES)
    return rows.select("review", "rating", F.col("date").cast("string").alias("date"), "likes", "bank", "source")
