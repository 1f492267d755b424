"""The lexicon grown from seeds against a plain computation, and what it is for."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators.induction import induced_lexicon, neighbour_edges
from revlens.operators.lexicon import add_compound_from_table

TEXTS = [
    "Great smooth payments, great smooth login",
    "great smooth payments. Smooth payments again",
    "awful laggy screens and awful laggy transfers",
    "it's laggy, laggy screens; AWFUL laggy payments",
    "the the the bank of the branch",
    "", None, "great", "naïve été naïve été awful été naïve",
]
SEEDS = {"great": 3.0, "awful": -2.0, "absent": 1.0}


def plain(texts, seeds, least, rounds, damping, faintest):
    edges = Counter()
    for text in texts:
        words = re.findall(r"[^\W]{2,}", re.sub("['’]", "", text or "").lower())
        for a, b in zip(words, words[1:]):
            if a != b:
                edges[frozenset((a, b))] += 1
    near = {}
    for pair, n in edges.items():
        if n >= least:
            for a in pair:
                (b,) = pair - {a}
                near.setdefault(a, {})[b] = n
    values = dict(seeds)
    for _ in range(rounds):
        reached = {a: [(n / sum(others.values()), values[b]) for b, n in others.items() if b in values] for a, others in near.items() if a not in seeds}
        values = {**seeds, **{a: damping * sum(s * v for s, v in met) for a, met in reached.items() if met}}
    return {w: round(v, 6) for w, v in values.items() if abs(v) >= faintest}


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(4)


@pytest.mark.parametrize("options", [(1, 1, 0.8, 0.01), (2, 3, 0.8, 0.05), (1, 4, 0.5, 0.0), (99, 2, 0.8, 0.05), (1, 0, 0.8, 0.05)])
def test_as_plainly_computed(reviews, options):
    found = {r.word: round(r.valence, 6) for r in induced_lexicon(reviews, "text", SEEDS, *options).collect()}
    assert found == pytest.approx(plain(TEXTS, SEEDS, *options))


def test_signs_follow_the_seeds(reviews):
    found = {r.word: r.valence for r in induced_lexicon(reviews, "text", SEEDS, least=2).collect()}
    assert found["smooth"] > 0.5 and found["laggy"] < -0.5 and "bank" not in found
    assert found["great"] == 3.0 and found["absent"] == 1.0


def test_feeds_the_scorer(reviews, spark):
    grown = induced_lexicon(reviews, "text", SEEDS, least=2)
    new = spark.createDataFrame([(1, "smooth"), (2, "laggy"), (3, "unheard of"), (4, None)], "id long, text string")
    scores = {r.id: r.compound for r in add_compound_from_table(new, "id", "text", grown).collect()}
    assert scores[1] > 0 > scores[2] and scores[3] == scores[4] == 0


def test_edges_go_both_ways(reviews):
    edges = {(r.a, r.b): r.n for r in neighbour_edges(reviews, "text", 1).collect()}
    assert all(edges[b, a] == n for (a, b), n in edges.items()) and ("the", "the") not in edges
    assert edges["laggy", "its"] == 1


def test_empty_table(reviews):
    assert {r.word for r in induced_lexicon(reviews.where(F.lit(False)), "text", SEEDS).collect()} == set(SEEDS)
