"""Lexicon sentiment: a compound score in [-1, 1] from word valences and their context."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.text import _col, words
from revlens.functions.vocab import BOOSTERS, LEXICON, NEGATORS
from revlens.operators.joins import spread_join

# Fixed values of the published rule-based scorer (Hutto & Gilbert, 2014).
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTION = 0.18, 0.96
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
NORMALISER = 15.0
NEUTRAL = 0.05


def _table(values: Mapping[str, float]) -> Column:
    return F.create_map(*[part for word, value in values.items() for part in (F.lit(word), F.lit(float(value)))])


def sentiment_tokens(text: Column | str) -> Column:
    return words(F.replace(F.replace(_col(text), F.lit("'"), F.lit("")), F.lit("’"), F.lit("")))


def compound(
    text: Column | str,
    lexicon: Mapping[str, float] = LEXICON,
    negators: Sequence[str] = NEGATORS,
    boosters: Mapping[str, float] = BOOSTERS,
) -> Column:
    """Score a text inside its row.

    Each lexicon word is shifted by boosters and flipped by negators among the three words before
    it, weighed by its side of the first "but", summed, and raised by `!` and repeated `?`.
    """
    valences = _table(lexicon)

    def hits(tokens: Column) -> Column:
        placed = F.transform(tokens, lambda word, i: F.struct(word.alias("word"), i.alias("i")))
        known = F.filter(placed, lambda hit: hit["word"].isin(list(lexicon)))
        return F.transform(known, lambda hit: F.struct(hit["i"].alias("i"), F.element_at(valences, hit["word"]).alias("own")))

    return _compound(text, hits, negators, boosters)


def _compound(
    text: Column | str, hits: Callable[[Column], Column], negators: Sequence[str], boosters: Mapping[str, float], tokens: Column | None = None
) -> Column:
    """The score, given the array (i, own) of the places and valences of a text's lexicon words, and its words, if they are known."""
    scored = _let(
        sentiment_tokens(text) if tokens is None else tokens,
        lambda tokens: _let(F.array_position(tokens, "but"), lambda but_at: _valence_sum(tokens, but_at, hits(tokens), negators, boosters)),
    )
    bangs = F.least(F.length(_col(text)) - F.length(F.replace(_col(text), F.lit("!"), F.lit(""))), F.lit(MAX_EXCLAMATIONS))
    questions = F.length(_col(text)) - F.length(F.replace(_col(text), F.lit("?"), F.lit("")))
    emphasis = bangs * EXCLAMATION + (
        F.when(questions <= 1, 0.0).when(questions <= 3, questions * QUESTION).otherwise(MAX_QUESTION)
    )
    raised = _let(scored, lambda total: total + F.signum(total) * emphasis)
    return F.coalesce(_let(raised, lambda total: total / F.sqrt(total * total + NORMALISER)), F.lit(0.0))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute `value` once per row and give it a name: a one-element array seen through a lambda."""
    return F.transform(F.array(value), use)[0]


def _valence_sum(tokens: Column, but_at: Column, hits: Column, negators: Sequence[str], boosters: Mapping[str, float]) -> Column:
    boosts = _table(boosters)

    def valence(hit: Column) -> Column:
        own = hit["own"]
        value = own
        negated = F.lit(False)
        for distance, damping in enumerate(DAMPING, start=1):
            earlier = F.when(hit["i"] >= distance, F.get(tokens, hit["i"] - distance))
            boost = F.when(earlier.isin(list(boosters)), F.element_at(boosts, earlier)).otherwise(0.0)
            value = value + F.signum(own) * boost * damping
            negated = negated | F.coalesce(earlier.isin(list(negators)), F.lit(False))
        value = F.when(negated, value * NEGATION).otherwise(value)
        side = F.when(but_at == 0, 1.0).when(hit["i"] + 1 < but_at, BEFORE_BUT).when(hit["i"] + 1 > but_at, AFTER_BUT)
        return value * side.otherwise(1.0)

    return F.aggregate(hits, F.lit(0.0), lambda total, hit: total + valence(hit))


def add_compound_from_table(
    df: DataFrame,
    row_id: str,
    text: str,
    lexicon: DataFrame,
    out: str = "compound",
    negators: Sequence[str] = NEGATORS,
    boosters: Mapping[str, float] = BOOSTERS,
    tokens: Column | None = None,
) -> DataFrame:
    """The score under a lexicon given as a table `(word, valence)`, one row per word, of any size.

    Ids, places and words meet the lexicon; the found places return to their rows. `tokens` are the `sentiment_tokens`
    of the text, if a column of `df` has them.
    """
    read = tokens
    tokens = df.select(row_id, F.posexplode_outer(sentiment_tokens(text) if read is None else read).alias("i", "word")).where("word is not null")
    found = spread_join(tokens, lexicon.select("word", F.col("valence").cast("double").alias("own")), ["word"], spread_on=row_id)
    lists = found.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("i", "own"))).alias("_hits"))
    none = F.array().cast("array<struct<i:int,own:double>>")
    joined = df.join(lists, row_id, "left")
    return joined.withColumn(out, _compound(text, lambda _: F.coalesce("_hits", none), negators, boosters, read)).drop("_hits")


def add_compound(df: DataFrame, text: str, out: str = "compound", **tables) -> DataFrame:
    return df.withColumn(out, compound(text, **tables))


def lexicon_sentiment(df: DataFrame, text: str, label: str = "sentiment_label", score: str = "sentiment_score") -> DataFrame:
    """Label and confidence from the compound score: between -0.05 and 0.05 it is ("neutral", 0.0)."""
    scored = df.withColumn("_c", compound(text))
    named = F.when(F.col("_c") >= NEUTRAL, "positive").when(F.col("_c") <= -NEUTRAL, "negative").otherwise("neutral")
    sure = F.when(F.abs("_c") >= NEUTRAL, 0.5 + F.abs("_c") / 2).otherwise(0.0)
    return scored.withColumns({label: named, score: sure}).drop("_c")
