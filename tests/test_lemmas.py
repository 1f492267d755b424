import pytest
from pyspark.sql import functions as F

from revlens.functions import text
from revlens.functions.lemmas import ENDS, RULES, base_form

FORMS = {
    "accounts": "account", "boxes": "box", "classes": "class", "branches": "branch", "companies": "company", "issues": "issue",
    "walking": "walk", "planning": "plan", "creates": "create", "managing": "manage", "charging": "charge", "enabled": "enable",
    "walked": "walk", "planned": "plan", "replied": "reply", "received": "receive", "updated": "update", "making": "make", "used": "use",
    "easier": "easy", "happiest": "happy", "bus": "bus", "class": "class", "thing": "thing", "bring": "bring", "need": "need", "speed": "speed",
    "news": "news", "morning": "morning", "red": "red", "status": "status", "this": "this", "s": "s", "": "", "123s": "123s", "él": "él",
}


def test_regular_forms(spark):
    rows = spark.createDataFrame([(w,) for w in [*FORMS, None]], "w string")
    found = {r.w: r.b for r in rows.select("w", base_form(F.col("w")).alias("b")).collect()}
    assert found == {**FORMS, None: None}


@pytest.mark.parametrize("lists", [{}, {"lemmas": {}}])
def test_normalise_with_rules(one, lists):
    assert one(text.normalise("t", otherwise=base_form, **lists), "Branches closing, accounts LOCKED") == "branch close account lock"


def test_patterns_are_tried_only_on_words_with_their_ends(spark):
    ends = sorted({end for some in ENDS for end in some} | {"", "eed", "sses", "ches", "using", "zing"})
    words = [(stem + end,) for stem in ("", "a", "re", "bo", "plan", "acces", "hop", "qui", "agre", "é", "st") for end in ends] + [(None,)]
    rows = spark.createDataFrame(words, "w string")
    word = F.col("w")
    assert rows.where(~base_form(word).eqNullSafe(base_form(word, list(RULES)))).isEmpty()
