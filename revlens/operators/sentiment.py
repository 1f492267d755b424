"""Sentiment labels with a confidence: a trained word model, and a hook for a caller's model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from revlens.functions.text import each, head_chars, is_blank, words
from revlens.operators.joins import spread_join

# A model of more words is not sent whole, whatever the session says: tasks look words up in their share of it.
SENT_WORDS = 1 << 19

SENTIMENT = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])


def label_from_rating(rating: Column | str) -> Column:
    """Four stars and more are positive, two and fewer negative, the rest has no label."""
    rating = F.col(rating) if isinstance(rating, str) else rating
    return F.when(rating >= 4, "positive").when(rating <= 2, "negative")


def label_counts(df: DataFrame, text: str, label: str, split: Callable[[str], Column] = words) -> DataFrame:
    """`(token, n, pos, neg)`: how often each word stands in all texts and in those with either label."""
    tokens = df.where(~is_blank(text)).select(label, each(split(text)).alias("token")).where("token is not null")
    return tokens.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col(label) == "positive", 1)).alias("pos"),
        F.count(F.when(F.col(label) == "negative", 1)).alias("neg"),
    )


def train_word_model(df: DataFrame, text: str, label: str, counts: DataFrame | None = None) -> DataFrame:
    """Multinomial naive Bayes as a table `(token, weight)`; the empty token holds the prior.

    A weight is the log odds of the word under "positive" against "negative", with add-one
    smoothing over all words of the labelled texts. `counts` are the `label_counts` of the texts, if they are known.
    """
    positive, negative = F.col(label) == "positive", F.col(label) == "negative"
    labelled = df.where(positive | negative)
    counts = label_counts(labelled, text, label) if counts is None else counts.where("pos > 0 or neg > 0")
    sums = counts.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("n"))).scalar()
    weight = F.log((F.col("pos") + 1) / (sums["pos"] + sums["n"])) - F.log((F.col("neg") + 1) / (sums["neg"] + sums["n"]))
    prior = labelled.agg(
        F.lit("").alias("token"),
        F.log((F.count(F.when(positive, 1)) + 1) / (F.count(F.when(negative, 1)) + 1)).alias("weight"),
    )
    return counts.select("token", weight.alias("weight")).unionByName(prior)


def add_sentiment(
    df: DataFrame,
    row_id: str,
    text: str,
    model: DataFrame,
    label: str = "sentiment_label",
    score: str = "sentiment_score",
    split: Callable[[str], Column] = words,
) -> DataFrame:
    """Label and confidence from the whole text; a text without a word of the model gives ("neutral", 0.0).

    Only ids and words meet the model. A model that was staged or read has a known size, and Spark broadcasts it
    when it is small; beyond `SENT_WORDS` words each task holds a share of the model and its words pass by, where sorting
    them would take memory by the size of the input.
    """
    known = model.where("token != ''")
    known = known.hint("shuffle_hash") if model.count() > SENT_WORDS else known
    tokens = df.where(~is_blank(text)).select(row_id, each(split(text)).alias("token")).where("token is not null")
    odds = spread_join(tokens, known, ["token"], spread_on=row_id).groupBy(row_id).agg(F.sum("weight").alias("_odds"))
    prior = F.coalesce(model.where("token = ''").select("weight").scalar(), F.lit(0.0))
    total = F.col("_odds") + prior
    return (
        df.join(odds, row_id, "left")
        .withColumn("_odds", total)
        .withColumns(
            {
                label: F.when(F.col("_odds").isNull(), "neutral").when(F.col("_odds") >= 0, "positive").otherwise("negative"),
                score: F.when(F.col("_odds").isNull(), 0.0).otherwise(1 / (1 + F.exp(-F.abs("_odds")))),
            }
        )
        .drop("_odds")
    )


def each_or_none(work: Callable[[list], Sequence], items: list) -> list:
    """The results of a batch function; if the batch fails, each item alone, None where that fails too."""
    try:
        return list(work(items)) if items else []
    except Exception:  # whatever a caller's function raises
        if len(items) == 1:
            return [None]
        return [each_or_none(work, [item])[0] for item in items]


def require_text(text: Column | str) -> Column:
    """The strict form: blank or missing text fails the query."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(is_blank(column), F.raise_error(F.lit("text must not be blank"))).otherwise(column)


def add_model_sentiment(
    df: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[list[str]], list[tuple[str, float]]]],
    batch_size: int = 256,
    max_chars: int | None = None,
    label: str = "sentiment_label",
    score: str = "sentiment_score",
) -> DataFrame:
    """Score with a caller's model, loaded once per Python worker and fed in Arrow batches.

    `load_model()` returns a function from texts to (label, score) pairs. Blank texts never reach
    it and give ("neutral", 0.0), as does a text the model returns nothing for or fails on: a batch that
    fails is tried again text by text. `max_chars` cuts the texts for a model with a bounded input.
    """

    def make_predict():
        predict = load_model()

        def batch(texts: np.ndarray) -> dict[str, np.ndarray]:
            wanted = [i for i, value in enumerate(texts) if value]
            labels = np.full(len(texts), "neutral", dtype=object)
            scores = np.zeros(len(texts), dtype="float64")
            results = each_or_none(predict, [texts[i] for i in wanted])
            for i, result in zip(wanted, results, strict=True):
                if result is not None:
                    labels[i], scores[i] = result[0].lower(), result[1]
            return {"label": labels, "score": scores}

        return batch

    model = predict_batch_udf(make_predict, return_type=SENTIMENT, batch_size=batch_size)
    given = F.when(is_blank(text), "").otherwise(F.col(text) if max_chars is None else head_chars(text, max_chars))
    scored = df.withColumn("_s", model(given))
    return scored.withColumns({label: F.col("_s.label"), score: F.col("_s.score")}).drop("_s")
