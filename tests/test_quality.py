import pytest
from pyspark.sql import functions as F

from revlens.operators import columns, profile, rows

SCHEMA = "`Name` string, `Age` double, `Join Date` string, `Unnamed:_0` int, `Text` string, `EmptyCol` string, `Duplicates` string, `LangText` string"
DATA = [
    ("Alice", 25.0, "2021-01-01", 1, "Hello 😀", None, "dup", "This is English"),
    ("Bob", 30.0, "2021-02-15", 2, "Bonjour", None, "dup", "Ceci est français"),
    ("Charlie", None, "not_a_date", 3, "Hola 😜", None, "unique", "Este es español"),
    ("Alice", 25.0, None, 4, None, None, "dup", "English too"),
    ("Alice", 25.0, "2021-01-01", 1, "Hello 😀", None, "dup", "This is English"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(DATA, SCHEMA)


@pytest.fixture
def tidy(raw):
    return columns.tidy_names(raw)


def test_names(raw):
    assert columns.tidy_names(raw).columns == ["name", "age", "join_date", "unnamed:_0", "text", "emptycol", "duplicates", "langtext"]
    assert "unnamed:_0" not in columns.tidy_columns(raw).columns


def test_repeated_names_keep_the_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("A", "a ", "B")
    got = columns.tidy_columns(df)
    assert got.columns == ["a", "b"]
    assert got.first() == (1, 3)


def test_rename_and_order(tidy):
    assert "years_old" in columns.rename_columns(tidy, {"age": "years_old", "absent": "x"}).columns
    first = columns.rename_first(tidy, {"age": "years_old", "name": "full_name", "absent": "x"})
    assert first.columns[:2] == ["years_old", "full_name"]
    assert first.columns[2:] == [c for c in tidy.columns if c not in ("age", "name")]


def test_drop_columns_and_required(tidy):
    assert "age" not in columns.drop_columns(tidy, ["age", "absent"]).columns
    with pytest.raises(ValueError, match="absent"):
        columns.require_columns(tidy, ["age", "absent"])


def test_empty_columns(tidy):
    assert "emptycol" not in columns.drop_empty_columns(tidy).columns
    nan = tidy.select(F.lit(float("nan")).alias("n"), "name")
    assert columns.drop_empty_columns(nan).columns == ["name"]


def test_timestamps(tidy):
    got = columns.to_timestamps(tidy)
    assert dict(got.dtypes)["join_date"] == "timestamp_ntz"
    assert got.where("join_date is not null").count() == 3
    report = columns.timestamp_report(tidy).first()
    assert report == ("join_date", 4, 3, 1)
    with pytest.raises(Exception, match="not a timestamp"):
        columns.to_timestamps(tidy, ["join_date"], errors="raise").collect()
    with pytest.raises(ValueError):
        columns.to_timestamps(tidy, errors="ignore")


def test_missing(tidy):
    got = {r["column_name"]: r for r in profile.missing_summary(tidy).collect()}
    assert got["age"]["n_missing"] == 1 and got["age"]["pct_text"] == "20.00%"
    assert got["emptycol"]["pct"] == 100.0
    above = {r["column_name"] for r in profile.missing_above(tidy, 10).collect()}
    assert above == {"age", "join_date", "text", "emptycol"}
    assert {r["column_name"] for r in profile.missing_above(tidy, 20).collect()} == {"emptycol"}


def test_missing_counts_nan_and_survives_an_empty_table(spark, tidy):
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert profile.missing_summary(nan).first()["n_missing"] == 2
    assert profile.missing_summary(tidy.limit(0)).where("pct is null").count() == 8
    assert columns.nan_to_null(nan).where("x is null").count() == 2


def test_duplicates(tidy):
    assert rows.duplicate_count(tidy).first()[0] == 1
    assert rows.duplicate_rows(tidy).count() == 1
    assert rows.duplicate_rows(tidy, "last").collect() == rows.duplicate_rows(tidy, "first").collect()
    assert rows.duplicate_rows(tidy, False).count() == 2
    assert rows.drop_duplicate_rows(tidy).count() == 4
    assert rows.drop_duplicate_rows(tidy, False).count() == 3
    assert rows.duplicate_count(rows.drop_duplicate_rows(tidy)).first()[0] == 0
    with pytest.raises(ValueError):
        rows.duplicate_rows(tidy, "middle")


def test_many_copies_are_all_listed(spark, monkeypatch):
    monkeypatch.setattr(rows, "_COPIES_PER_CHUNK", 7)
    df = spark.range(100).select((F.col("id") % 3 == 0).alias("hot"), F.lit(None).cast("string").alias("n"))
    got = {r["hot"]: r["count"] for r in rows.duplicate_rows(df).groupBy("hot").count().collect()}
    assert got == {True: 33, False: 65}
    assert rows.duplicate_rows(df, False).count() == 100


def test_invalid_values(spark, tidy):
    df = tidy.withColumn("text", F.when(F.col("text") == "Bonjour", " NA ").otherwise(F.col("text")))
    assert [tuple(r) for r in profile.invalid_values(df).collect()] == [("text", 1)]
    assert profile.invalid_values(df, ["nothing"]).count() == 0
    many = spark.createDataFrame([(i, " - ") for i in range(9)] + [(9, "")], "id int, t string")
    assert profile.invalid_values(many, []).first()["n_invalid"] == 1
    got = profile.invalid_examples(many, "id").orderBy("rank").collect()
    assert [(r["id"], r["value"]) for r in got] == [(i, " - ") for i in range(5)]


def test_drop_missing(tidy):
    assert rows.drop_missing(tidy, ["age", "absent"]).count() == 4
    assert rows.drop_missing(tidy, []).count() == 5
    assert rows.drop_missing(tidy, ["absent"]).count() == 5


def test_step_report(tidy):
    steps = {"age": F.col("age").isNotNull(), "alice": F.col("name") == "Alice"}
    assert [tuple(r) for r in rows.step_report(tidy, steps).collect()] == [("age", 5, 4, 1), ("alice", 4, 3, 1)]


def test_profiles(tidy):
    text = {r["column_name"]: r for r in profile.text_profile(tidy).collect()}
    assert tuple(text["name"])[1:] == (5, 3, "Alice", 3)
    assert tuple(text["duplicates"])[1:] == (5, 2, "dup", 4)
    ages = profile.number_profile(tidy.select("age")).first()
    assert (ages["n"], ages["mean"], ages["q1"], ages["median"], ages["q3"], ages["max_value"]) == (4, 26.25, 25.0, 25.0, 26.25, 30.0)
    info = {r["column_name"]: (r["dtype"], r["n_values"]) for r in profile.column_info(tidy).collect()}
    assert info["age"] == ("double", 4) and info["emptycol"] == ("string", 0)
    distinct = {r["column_name"]: r["n_distinct"] for r in profile.distinct_counts(tidy).collect()}
    assert distinct["text"] == 3 and distinct["emptycol"] == 0
    assert profile.table_shape(tidy).first() == (5, 8)


def test_head_tail_sample(spark):
    df = spark.range(50)
    assert [r["id"] for r in rows.head(df, "id", 3).collect()] == [0, 1, 2]
    assert [r["id"] for r in rows.tail(df, "id", 3).collect()] == [49, 48, 47]
    first = [r["id"] for r in rows.sample_rows(df, "id", 7, seed=1).collect()]
    again = [r["id"] for r in rows.sample_rows(df.repartition(5), "id", 7, seed=1).collect()]
    other = [r["id"] for r in rows.sample_rows(df, "id", 7, seed=2).collect()]
    assert first == again and first != other and len(set(first)) == 7


def test_prepare_for_charts(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("bad", "b"), ("2024-01-02", None)], "date string, review string")
    assert columns.prepare_for_charts(df, ["date", "review"]).count() == 1
    with pytest.raises(ValueError, match="rating"):
        columns.prepare_for_charts(df, ["date", "review", "rating"])
