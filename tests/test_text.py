import pytest
from pyspark.sql import functions as F

from revlens.functions import dates, lists, text
from revlens.functions.vocab import EMOJI_WORDS, LEMMAS, STOP_WORDS
from revlens.operators.normalise import add_cleaned_text_from_tables

# Texts and their normal forms.
NORMALISED = [
    ("Best Mobile Banking App EVER!", "good mobile banking app"),
    ("It was good, but it doesn't work right.", "good not work right"),
    ("👌👍", ""),
    ("", ""),
    (None, ""),
    ("dedeb", "dedeb"),
    ("1234", "1234"),
    ("true", "true"),
    ('["test"]', "test"),
    ("  Tabs\tand\nlines  stay apart ", "tabs lines stay apart"),
    ("Écran cassé, ñandú", "écran cassé ñandú"),
]


@pytest.mark.parametrize("given, wanted", NORMALISED)
def test_normalise(one, given, wanted):
    assert one(text.normalise("t"), given) == wanted


def test_normalise_drops_function_words(one):
    words = one(text.normalise("t"), "This is an example of a sentence with many stopwords.").split()
    assert words == ["example", "sentence", "stopword"]


def test_normalise_by_tables_gives_the_same(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NORMALISED)], "id int, t string")
    stops = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    bases = spark.createDataFrame(list(LEMMAS.items()), "word string, base string")
    got = {r["id"]: r["cleaned_text"] for r in add_cleaned_text_from_tables(rows, "id", "t", stops, bases).collect()}
    assert got == {i: wanted for i, (_, wanted) in enumerate(NORMALISED)}


def test_normalise_by_tables_moves_texts_and_found_words(spark):
    """Ids that repeat share their words place by place, entries may repeat or be null; no single word of a text is moved but those found."""
    rows = spark.createDataFrame([(1, "The cats ran, the"), (2, " dogs  ran"), (2, "Cats the x"), (2, "Cats the x"), (3, None), (4, " "), (None, "cats")], "id int, t string")
    stops = spark.createDataFrame([("the",), ("the",), (None,)], "word string")
    bases = spark.createDataFrame([("cats", "cat"), ("cats", "a pet"), ("ran", "run"), ("ran", None), ("the", "a"), (None, "none"), ("", "empty")], "word string, base string")
    got = add_cleaned_text_from_tables(rows, "id", "t", stops, bases)
    two = "a pet a pet cat cat dogs ran run x x"
    assert sorted((r["id"] or 0, r["cleaned_text"]) for r in got.collect()) == [(0, ""), (1, "a pet cat ran run"), (2, two), (2, two), (2, two), (3, ""), (4, "")]
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("Hello 😀", "Hello happy"),
        ("Hola 😜", "Hola playful"),
        ("so ☹️ today", "so sad today"),
        ("plain ☹ sign", "plain sign"),
        ("ok 👍🏽 👨‍👩‍👧 done", "ok done"),
        ("🤯🤯", "mind blown mind blown"),
        ("no  emoji\there", "no emoji here"),
        ("", ""),
        (None, None),
    ],
)
def test_emoji(one, given, wanted):
    assert one(text.replace_emoji("t"), given) == wanted


def test_emoji_map_of_the_caller_replaces_the_default(one):
    assert one(text.replace_emoji("t", {"👍": " yes "}), "a 👍 b 😀") == "a yes b"


def test_emoji_map_is_applied_in_order_when_entries_interact(one):
    assert one(text.replace_emoji("t", {"a": "b", "b": "c"}), "ab") == "cc"
    assert one(text.replace_emoji("t", {":)": " fine "}), "all :) 😀") == "all fine"


def test_one_pass_equals_entry_by_entry(spark):
    mixed = [f"x{a}y {b}{a} z☹{b}" for a, b in zip(EMOJI_WORDS, reversed(EMOJI_WORDS))]
    rows = spark.createDataFrame([(t,) for t in mixed], "t string")
    chained = F.col("t")
    for emoji, word in EMOJI_WORDS.items():
        chained = F.replace(chained, F.lit(emoji), F.lit(word))
    chained = text.squeeze(F.regexp_replace(chained, text.EMOJI, ""))
    assert rows.where(~text.replace_emoji("t").eqNullSafe(chained)).count() == 0


def test_blank_and_trim(one):
    for blank in ("", "   ", "\n\t", " ", None):
        assert one(text.is_blank("t"), blank) is True
    assert one(text.is_blank("t"), " a ") is False
    assert one(text.strip("t"), "\t a b\n") == "a b"


def test_words_and_head(one):
    assert one(text.words("t"), "A bb, Été_1 c-dd") == ["bb", "été_1", "dd"]
    assert len(one(text.head_chars("t"), "é" * 600)) == 512


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("['a b', 'c']", ["a b", "c"]),
        ('["it\'s", "c"]', ["it's", "c"]),
        ("garbage", []),
        ("['it's']", []),
        (None, []),
    ],
)
def test_parse_list(one, given, wanted):
    assert one(lists.parse_list("t"), given) == wanted


def test_list_text(one):
    assert one(lists.repair_json_list("t"), "['a', 'b']") == '["a","b"]'
    assert one(lists.repair_json_list("t"), "nothing") == "[]"
    assert one(lists.split_themes("t"), " A, b ,,C ") == ["a", "b", "c"]
    assert one(lists.split_themes("t"), None) == []
    assert one(lists.themes_of("t"), '["Feature Requests", "UI"]') == ["feature requests", "ui"]
    assert one(lists.themes_of("t"), "Reliability, UI") == ["reliability", "ui"]
    assert one(lists.strip_brackets("t"), "[a, b] c]") == "a, bc"


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2021-01-01", "2021-01-01 00:00:00"),
        (" 2021-01-01 10:00:00 ", "2021-01-01 10:00:00"),
        ("2024-01-01T12:00:00Z", "2024-01-01 12:00:00"),
        ("2024-01-01T12:00:00+03:00", "2024-01-01 09:00:00"),
        ("2024-01-01 00:30:00-0130", "2024-01-01 02:00:00"),
        ("2021-01-01 00:00:00+03", "2020-12-31 21:00:00"),
        ("2021-01-01 00:00:00.25 UTC+3", "2020-12-31 21:00:00.25"),
        ("2021-07-01 00:00:00 Europe/Paris", "2021-06-30 22:00:00"),
        ("2021-01-01T00:00:00 EST", "2021-01-01 05:00:00"),
        ("2021-11-07T05:30:00Z", "2021-11-07 05:30:00"),
        ("1901-02-03T04:05:06-00:30", "1901-02-03 04:35:06"),
        ("2021-01-01 00:00:00 Nowhere/Land", None),
        ("not_a_date", None),
        ("N/A", None),
        ("NaT", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, one, given, wanted):
    assert one(dates.parse_timestamp("t").cast("string"), given) == wanted
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(dates.parse_timestamp("t").cast("string"), given) == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_timestamp_with_formats_and_strict(one):
    assert one(dates.parse_timestamp("t", ["dd/MM/yyyy"]).cast("string"), "31/12/2020") == "2020-12-31 00:00:00"
    assert one(dates.parse_timestamp_strict("t").cast("string"), "N/A") is None
    with pytest.raises(Exception, match="not a timestamp"):
        one(dates.parse_timestamp_strict("t").cast("string"), "not_a_date")


def test_week_ending_is_the_sunday(one):
    for day, sunday in (("2024-01-01", "2024-01-07"), ("2024-01-07 12:00:00", "2024-01-07"), ("2024-01-08", "2024-01-14")):
        assert one(dates.week_ending(F.col("t").cast("timestamp_ntz")).cast("string"), day) == sunday


def test_percent_text(one):
    assert one(text.percent_text("t"), 12.345678, "t double") == "12.35%"
