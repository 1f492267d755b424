"""A sentiment lexicon grown from seed words over the graph of neighbouring words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from revlens.functions.vocab import LEXICON
from revlens.operators.keywords import Split, word_pairs
from revlens.operators.lexicon import sentiment_tokens
from revlens.session import stage

LEAST, ROUNDS, DAMPING, FAINTEST = 3, 3, 0.8, 0.05


def neighbour_edges(df: DataFrame, text: str, least: int = LEAST, split: Split = sentiment_tokens) -> DataFrame:
    """(a, b, n): two different words that stand side by side n times, `least` or more; each pair in both directions.

    Words are read as the lexicon score reads them. Pairs are counted before they move.
    """
    pairs = word_pairs(df.select(text), [], text, split).where("next is not null and word <> next")
    counts = pairs.groupBy(F.least("word", "next").alias("a"), F.greatest("word", "next").alias("b")).agg(F.count("*").alias("n"))
    kept = stage(counts.where(F.col("n") >= least), "neighbours")
    return kept.union(kept.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))


def induced_lexicon(
    df: DataFrame,
    text: str,
    seeds: Mapping[str, float] = LEXICON,
    least: int = LEAST,
    rounds: int = ROUNDS,
    damping: float = DAMPING,
    faintest: float = FAINTEST,
    split: Split = sentiment_tokens,
) -> DataFrame:
    """(word, valence) of the seeds and of the words that they reach in `rounds` steps.

    In each round a word takes the mean valence of its neighbours, weighed by how often they meet, times `damping`;
    neighbours that have none yet count as zero, so that common words stay faint. Seeds keep their valence. Words fainter
    than `faintest` are left out at the end. A hub's edges are combined before they move; every round is staged.
    """
    edges = neighbour_edges(df, text, least, split)
    given = df.sparkSession.createDataFrame([(w, float(v)) for w, v in seeds.items()], "word string, valence double")
    free = edges.join(given.select(F.col("word").alias("a")), "a", "left_anti")
    shares = stage(free.join(free.groupBy("a").agg(F.sum("n").alias("all")), "a").select("a", F.col("b").alias("word"), (F.col("n") / F.col("all")).alias("share")), "shares")
    valences = given
    for _ in range(rounds):
        reached = shares.join(valences, "word").groupBy("a").agg((F.sum(F.col("share") * F.col("valence")) * damping).alias("valence"))
        valences = stage(given.union(reached.select(F.col("a").alias("word"), "valence")), "valences")
    return valences.where(F.round(F.abs("valence"), 6) >= faintest)
