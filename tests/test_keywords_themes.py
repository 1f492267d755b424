import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators.keywords import add_keywords, term_weights, vocabulary
from revlens.operators.themes import add_themes, assign_themes, themes_of_text

# Keyword lists and the themes they must give.
THEMES = [
    (["login issue", "password reset"], ["Account Access Issues"]),
    (["app crash", "very slow"], ["Reliability", "Transaction Performance"]),
    (["great support", "poor interface"], ["Customer Support", "User Experience"]),
    (["new feature", "update required"], ["Feature Requests"]),
    (["login", "support", "feature"], ["Account Access Issues", "Customer Support", "Feature Requests"]),
    ([], ["Miscellaneous"]),
    (["randomword", "unknown term"], ["Miscellaneous"]),
    (["foo", "bar", "baz"], ["Miscellaneous"]),
    (["Login", "SUPPORT"], ["Account Access Issues", "Customer Support"]),
    (["app crashing", "login failed"], ["Account Access Issues", "Reliability"]),
    (["log", "in"], ["Miscellaneous"]),
    (None, ["Miscellaneous"]),
]


@pytest.mark.parametrize("given, wanted", THEMES)
def test_assign_themes(one, given, wanted):
    assert one(assign_themes("k"), given, "k array<string>") == wanted


def test_themes_of_text_and_own_rules(one):
    assert one(themes_of_text("t"), "My LOGIN is slow") == ["Account Access Issues", "Transaction Performance"]
    assert one(themes_of_text("t"), None) == ["Miscellaneous"]
    assert one(themes_of_text("t", {"fee": "Cost"}, "Other"), "high Fees") == ["Cost"]
    assert one(themes_of_text("t", {"fee": "Cost"}, "Other"), "login") == ["Other"]


def by_hand(texts, top_k, max_terms=1000):
    docs = []
    for text in texts:
        words = re.findall(r"\b\w\w+\b", text.lower())
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    n = sum(1 for text in texts if text.strip())
    total = sum(docs, Counter())
    kept = {t for t, _ in sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:max_terms]}
    df = {t: sum(t in d for d in docs) for t in kept}
    result = []
    for doc in docs:
        raw = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in doc.items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        ranked = sorted(raw, key=lambda t: (-round(raw[t] / norm, 12), t))
        result.append(({t: raw[t] / norm for t in raw}, ranked[:top_k]))
    return result


TEXTS = [
    "This is a great app for finance",
    "The app has excellent features and great usability",
    "Finance tools and features are very helpful",
    "123 456 !@# $%^",
    "finance $$$ app ***",
    "",
    "   ",
    "\n",
    "a b c",
    "slow slow slow app, slow App",
    "Émile écrit à l'été",
]


@pytest.mark.parametrize("max_terms", [1000, 12])
def test_keywords_equal_brute_force(spark, max_terms):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    wanted = by_hand(TEXTS, 4, max_terms)
    got = {r["id"]: r["keywords"] for r in add_keywords(rows, "id", "t", 4, max_terms).collect()}
    assert got == {i: kws for i, (_, kws) in enumerate(wanted)}
    weights = {(r["id"], r["term"]): r["weight"] for r in term_weights(rows, "id", "t", max_terms).collect()}
    flat = {(i, t): w for i, (ws, _) in enumerate(wanted) for t, w in ws.items()}
    assert weights.keys() == flat.keys()
    assert all(weights[k] == pytest.approx(flat[k]) for k in flat)


@pytest.mark.parametrize("max_terms", [1, 3, 7, 20, 500])
def test_vocabulary_equals_brute_force_with_many_ties(spark, max_terms):
    rng = random.Random(max_terms)
    names = [f"{a}{b}" for a in "abcdef" for b in "xyz"]
    texts = [" ".join(rng.choices(names, weights=[30, 9, 9, 5] + [1] * 14, k=rng.randrange(12))) for _ in range(40)]
    total = Counter()
    for text in texts:
        words = text.split()
        total.update(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    wanted = sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:max_terms]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    assert [tuple(r) for r in vocabulary(rows, "id", "t", max_terms).collect()] == wanted


def test_blank_corpus_gives_empty_lists(spark):
    rows = spark.createDataFrame([(0, ""), (1, "   "), (2, "\n"), (3, None), (4, "a")], "id long, t string")
    assert [r["keywords"] for r in add_keywords(rows, "id", "t").collect()] == [[]] * 5


def test_keyword_counts_and_repeat_runs(spark):
    rows = spark.createDataFrame([(0, "keyword1 keyword2 keyword3 keyword4 keyword5 keyword6"), (1, "keyword1 keyword2 keyword3")], "id long, t string")
    first = add_keywords(rows, "id", "t", 4).orderBy("id").collect()
    assert all(len(r["keywords"]) <= 4 for r in first)
    assert first == add_keywords(rows.repartition(3), "id", "t", 4).orderBy("id").collect()
    assert vocabulary(rows, "id", "t", 2).collect()[0]["term"] == "keyword1"


def test_themes_follow_keywords(spark):
    rows = spark.createDataFrame([(0, "login login login"), (1, "nothing here")], "id long, t string")
    got = {r["id"]: r["themes"] for r in add_keywords(rows, "id", "t").transform(add_themes).collect()}
    assert got == {0: ["Account Access Issues"], 1: ["Miscellaneous"]}


def test_the_text_is_computed_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        read.add(1)
        return f"good app number{i % 7} slow app"

    rows = spark.range(40).select("id", text("id").alias("t"))
    assert term_weights(rows, "id", "t").where("term = 'app'").agg({"tf": "sum"}).first()[0] == 80
    # the test for blank texts may read a text once more
    assert read.value <= 80
