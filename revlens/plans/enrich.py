"""Cleaned reviews to scored reviews: text, sentiment, keywords, themes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions.text import joined_words, joined_words_of_normal, normalise, replace_emoji, split_words
from revlens.operators.columns import rename_columns
from revlens.operators.keywords import MAX_TERMS, attach_keywords, keyword_lists
from revlens.operators.lexicon import lexicon_sentiment
from revlens.operators.sentiment import add_sentiment, label_counts, label_from_rating, train_word_model
from revlens.operators.themes import add_themes
from revlens.session import stage
from revlens.sources.files import lists_as_text, load, read_csv, write_csv, write_parquet

_ROW, _WORDS = "_row", "_words"


def prepare_text(reviews: DataFrame, text: str = "review_text", emoji_first: bool = True) -> DataFrame:
    """Add `cleaned_text`, which is empty where nothing is left of the text.

    Emoji become words before punctuation goes, or they would be lost with it. With
    `emoji_first=False` they are lost.
    """
    cleaned = normalise(replace_emoji(text)) if emoji_first else replace_emoji(normalise(text))
    return reviews.withColumn("cleaned_text", cleaned)


def enrich_reviews(
    reviews: DataFrame,
    model: DataFrame | None = None,
    row_id: str | None = "review_id",
    top_k: int = 5,
    max_terms: int = MAX_TERMS,
    emoji_first: bool = True,
) -> DataFrame:
    """The whole chain over reviews with `review` (or `review_text`) and, if there is one, `rating`.

    The prepared text and its words are staged once, because the sentiment and keyword steps each read them; reviews
    with nothing left are dropped behind that, so that the test does not compute the text again.
    Only ids and cleaned texts are scored; their results meet the other columns in one join. Without a
    model, one is trained on the reviews whose rating tells their sentiment; without ratings either,
    the lexicon scores. With `row_id=None` the rows are numbered and the number is left out again.
    """
    named = rename_columns(reviews, {"review": "review_text"}) if "review" in reviews.columns else reviews
    if row_id is None:
        numbered = named.withColumn(_ROW, F.monotonically_increasing_id())
        return enrich_reviews(numbered, model, _ROW, top_k, max_terms, emoji_first).drop(_ROW)
    read = prepare_text(named, emoji_first=emoji_first).withColumn(_WORDS, (joined_words_of_normal if emoji_first else joined_words)("cleaned_text"))
    prepared = stage(read, "prepared").where("cleaned_text != ''")
    slim = prepared.select(row_id, "cleaned_text", _WORDS)
    counts = None
    if model is None and "rating" in prepared.columns:
        labelled = prepared.select(_WORDS, label_from_rating("rating").alias("label"))
        counts = stage(label_counts(labelled, _WORDS, "label", split_words), "word-counts")
        model = stage(train_word_model(labelled, _WORDS, "label", counts), "model")
        counts = counts.select(F.col("token").alias("word"), F.col("n").alias("corpus_count"))
    scored = lexicon_sentiment(slim, "cleaned_text") if model is None else add_sentiment(slim, row_id, _WORDS, model, split=split_words)
    keywords = keyword_lists(slim, row_id, _WORDS, top_k, max_terms, joined=True, counts=counts)
    found = attach_keywords(scored.drop("cleaned_text", _WORDS), keywords, row_id).transform(add_themes)
    return prepared.drop(_WORDS).join(found, row_id)


def run_pipeline(spark: SparkSession, source: str, target: str, **options) -> DataFrame:
    """Read reviews from CSV or Parquet (by the name's ending), score them, write and return the result.

    The input needs a column `review` or `review_text` alone. CSV holds lists as JSON text.
    """
    kinds = ["csv" if path.rstrip("/").lower().endswith(".csv") else "parquet" for path in (source, target)]
    reviews = load(spark, source, kinds[0], **({"inferSchema": False} if kinds[0] == "csv" else {}))
    if "rating" in reviews.columns:
        reviews = reviews.withColumn("rating", F.col("rating").try_cast("double"))
    scored = enrich_reviews(reviews, row_id=None, **options)
    if kinds[1] == "csv":
        write_csv(scored, target)
        return read_csv(spark, target, lists_as_text(scored).schema)
    write_parquet(scored, target)
    return spark.read.parquet(target)
