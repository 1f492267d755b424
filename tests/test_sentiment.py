import math

import pytest
from pyspark.sql import functions as F

from revlens.operators import language, sentiment
from revlens.operators.lexicon import add_compound_from_table, compound

TRAINING = [
    ("I love this amazing app", "positive"),
    ("great design, love using it", "positive"),
    ("amazing fintech app", "positive"),
    ("keeps crashing, so frustrating", "negative"),
    ("terrible service, crashing app", "negative"),
    ("frustrating login", "negative"),
    ("no opinion", None),
]


@pytest.fixture(scope="module")
def model(spark):
    return sentiment.train_word_model(spark.createDataFrame(TRAINING, "t string, label string"), "t", "label")


def scored(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    return [(r["sentiment_label"], r["sentiment_score"]) for r in sentiment.add_sentiment(rows, "id", "t", model).orderBy("id").collect()]


def test_clear_cut_texts(spark, model):
    positive, negative, mixed = scored(
        spark,
        model,
        ["I love using this fintech app. It's amazing!", "The app keeps crashing. It's so frustrating!", "I like the design but the service is terrible."],
    )
    assert positive[0] == "positive" and negative[0] == "negative" and mixed[0] in ("positive", "negative")
    assert all(0.5 <= score <= 1 for _, score in (positive, negative, mixed))


def test_blank_texts_and_texts_of_unknown_words_are_neutral(spark, model):
    assert scored(spark, model, ["", "   ", None, "qqq", "zzz yyy"]) == [("neutral", 0.0)] * 5


def test_the_whole_text_counts(spark, model):
    long = "love " * 9_000
    assert [label for label, _ in scored(spark, model, [long, long + "terrible " * 30_000])] == ["positive", "negative"]


def test_a_model_without_its_prior_still_scores(spark, model):
    assert [label for label, _ in scored(spark, model.where("token != ''"), ["love", "terrible", ""])] == ["positive", "negative", "neutral"]


def test_words_meet_a_large_model_unsorted(spark, model, monkeypatch):
    texts = ["love " * 50, "terrible service", "crashing " * 30 + "love", "zzz", ""]
    wanted = scored(spark, model, texts)
    monkeypatch.setattr(sentiment, "SENT_WORDS", model.count() - 1)
    assert scored(spark, model, texts) == wanted
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    plan = sentiment.add_sentiment(rows, "id", "t", model)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [token" in plan and "SortMergeJoin [token" not in plan


def test_weights_by_hand(model):
    weights = {r["token"]: r["weight"] for r in model.collect()}
    words = {w for t, label in TRAINING if label for w in __import__("re").findall(r"\w\w+", t.lower())}
    pos = sum(len(__import__("re").findall(r"\w\w+", t)) for t, label in TRAINING if label == "positive")
    neg = sum(len(__import__("re").findall(r"\w\w+", t)) for t, label in TRAINING if label == "negative")
    assert set(weights) == words | {""}
    assert weights["love"] == pytest.approx(math.log(3 / (pos + len(words))) - math.log(1 / (neg + len(words))))
    assert weights[""] == pytest.approx(0.0)


def test_strict_form_rejects_blank_text(one):
    assert one(sentiment.require_text("t"), "fine") == "fine"
    for bad in ("", "  ", None):
        with pytest.raises(Exception, match="blank"):
            one(sentiment.require_text("t"), bad)


def test_caller_model(spark):
    def load():
        def predict(texts):
            assert all(t.strip() and len(t) <= 512 for t in texts)
            if "broken" in texts:
                raise RuntimeError("the model fails on this text")
            return [None if t == "unsure" else ("POSITIVE", len(t) / 512) for t in texts]

        return predict

    rows = spark.createDataFrame([(0, "x" * 600), (1, "  "), (2, None), (3, "unsure"), (4, "broken"), (5, "y" * 256)], "id long, t string").coalesce(1)
    got = sentiment.add_model_sentiment(rows, "t", load, max_chars=512).orderBy("id").collect()
    neutral = ("neutral", 0.0)
    assert [(r["sentiment_label"], r["sentiment_score"]) for r in got] == [("positive", 1.0), neutral, neutral, neutral, neutral, ("positive", 0.5)]


def test_label_from_rating(one):
    wanted = {1: "negative", 2: "negative", 3: None, 4: "positive", 5: "positive", None: None}
    assert {r: one(sentiment.label_from_rating("t"), r, "t int") for r in wanted} == wanted


def norm(total):
    return total / math.sqrt(total * total + 15)


@pytest.mark.parametrize(
    "text, total",
    [
        ("good", 1.9),
        ("not good", 1.9 * -0.74),
        ("it does not look very good", (1.9 + 0.293) * -0.74),
        ("never in a million years good", 1.9),
        ("very good", 1.9 + 0.293),
        ("very much good", 1.9 + 0.293 * 0.95),
        ("very bad", -2.5 - 0.293),
        ("slightly bad", -2.5 + 0.293),
        ("good!!", 1.9 + 2 * 0.292),
        ("bad!!!!!!", -2.5 - 4 * 0.292),
        ("good??", 1.9 + 0.36),
        ("good????", 1.9 + 0.96),
        ("good?", 1.9),
        ("good but slow", 1.9 * 0.5 - 1.3 * 1.5),
        ("isn't good", 1.9 * -0.74),
        ("nothing to say here!!", 0.0),
        ("", 0.0),
        (None, 0.0),
    ],
)
def test_compound(one, text, total):
    # "nothing" negates but has no valence of its own.
    assert one(compound("t"), text) == pytest.approx(norm(total))


def test_compound_stays_in_range_and_takes_a_lexicon(one):
    assert -1 <= one(compound("t"), "worst terrible horrible bad!!!! " * 50) < -0.99
    assert one(compound("t", lexicon={"gut": 2.0}), "gut good") == pytest.approx(norm(2.0))


def test_a_lexicon_of_ten_thousand_words_as_a_table(spark):
    lexicon = {f"word{i}": (i % 9 - 4) / 2 for i in range(10_000)}
    texts = [" ".join(f"word{(i * j * 37) % 12_000}" for j in range(40)) + " but not very word7!" * (i % 3) for i in range(30)] + ["", None, "none here"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    table = spark.createDataFrame(list(lexicon.items()), "word string, valence double")
    got = {r["id"]: r["compound"] for r in add_compound_from_table(rows, "id", "t", table).collect()}
    used = {w: v for w, v in lexicon.items() if any(t and w in t.split() for t in texts) or w == "word7"}
    wanted = {r["id"]: r["c"] for r in rows.select("id", compound("t", used).alias("c")).collect()}
    assert got == pytest.approx(wanted) and len(got) == 33


def test_languages_are_told_apart(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # Each text is on one side only: copies fall on the side of their text.
    side = F.conv(F.substring(F.md5("text"), 1, 1), 16, 10).cast("int") % 2
    langs = ["de", "en", "es", "fr"]
    profiles = language.train_profiles(documents.where(side == 0), "text", "lang", langs)
    found = language.add_language(documents.where(side == 1), "doc_id", "text", profiles, langs)
    right = found.agg(F.avg((F.col("lang") == F.col("detected_lang")).cast("int"))).first()[0]
    assert right > 0.97


@pytest.fixture(scope="module")
def small_profiles(spark):
    texts = [("en", "the cat and the dog sat on the mat this is english"), ("fr", "le chat et le chien sont sur le tapis ceci est français")]
    return language.train_profiles(spark.createDataFrame(texts, "lang string, t string"), "t", "lang", ["en", "fr"])


def test_undetectable_text_has_no_language(spark, small_profiles):
    rows = spark.createDataFrame([(0, "this is the english"), (1, "123 😀"), (2, ""), (3, None), (4, "ceci est le chien")], "id long, t string")
    got = {r["id"]: r["detected_lang"] for r in language.add_language(rows, "id", "t", small_profiles, ["en", "fr"]).collect()}
    assert got == {0: "en", 1: None, 2: None, 3: None, 4: "fr"}
    kept = language.keep_language(rows, "id", "t", small_profiles, ["en", "fr"])
    assert [r["id"] for r in kept.collect()] == [0]


def test_translate(spark, tmp_path):
    rows = spark.createDataFrame(
        [(0, "Hello", "en"), (1, "Bonjour", "fr"), (2, "Bonjour", "fr"), (3, "Hola", "es"), (4, None, None), (5, "???", None), (6, "Bad", "xx"), (7, "Down", "yy")],
        "id long, t string, lang string",
    )
    memory = spark.createDataFrame(
        [("fr", "Bonjour", "Good day"), ("fr", "Bonjour", "Hello there"), ("en", "Hello", "never")], "lang string, text string, translation string"
    )
    kept = {r["id"]: r["t"] for r in language.translate(rows, "id", "t", "lang", memory).collect()}
    assert kept == {0: "Hello", 1: "Good day", 2: "Good day", 3: "Hola", 4: None, 5: "???", 6: "Bad", 7: "Down"}

    calls = str(tmp_path)

    def service(batch):
        import os
        import uuid

        for text in batch["text"]:
            open(os.path.join(calls, f"{text}-{uuid.uuid4().hex}"), "w").close()
        if len(batch) > 1 and "xx" in list(batch["lang"]) or list(batch["lang"]) == ["yy"]:
            raise RuntimeError("the service is down")
        return [None if lang == "xx" else f"{lang}:{text}" for lang, text in zip(batch["lang"], batch["text"])]

    twice = rows.unionByName(rows.withColumn("id", F.col("id") + 10))
    full = {r["id"]: r["t"] for r in language.translate(twice, "id", "t", "lang", memory, service).collect()}
    assert full[3] == full[13] == "es:Hola" and full[6] == "Bad" and full[7] == "Down" and full[1] == "Good day"
    import os

    assert {name.split("-")[0] for name in os.listdir(calls)} == {"Bad", "Down", "Hola"}
