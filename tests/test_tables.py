"""Landing, warehouse, files, insights, the scoring chain and streams."""

import pytest
from pyspark.sql import functions as F

from revlens import schemas
from revlens.operators import insights, warehouse as ops
from revlens.operators.language import train_profiles
from revlens.plans.enrich import enrich_reviews, run_pipeline
from revlens.plans.explore import explore
from revlens.plans.ingest import ingest
from revlens.session import fresh_path, shared_folder
from revlens.sources import files, landing, warehouse
from revlens.streaming import jobs


def raw(spark, rows):
    return spark.createDataFrame(rows, "review_id long, bank string, content string, score int, review_ts string").withColumn(
        "review_ts", F.col("review_ts").cast("timestamp_ntz")
    )


PAGE = [
    (1, "A", "Great!", 5, "2024-01-01 12:00:00"),
    (2, "A", "Bad.", 1, "2024-01-01 12:00:00"),
    (3, "A", "Great!", 5, "2024-01-01 13:00:00"),
    (4, "A", None, 4, "2024-01-04 12:00:00"),
    (5, "B", "Great!", 3, "2024-01-01 12:00:00"),
]


def test_clean_reviews(spark):
    got = landing.clean_reviews(raw(spark, PAGE)).drop("review_ts").orderBy("review_id")
    assert got.columns == ["review_id", "review", "rating", "date", "bank", "source"]
    assert [r["review_id"] for r in got.collect()] == [2, 3, 5]
    assert {r["source"] for r in got.collect()} == {"Google Play"} and {r["date"] for r in got.collect()} == {"2024-01-01"}
    again = landing.clean_reviews(raw(spark, PAGE + PAGE))
    assert again.count() == 3


def test_repeats_go_before_incomplete_rows(spark):
    rows = raw(spark, [(1, "A", "x", 5, "2024-01-01 10:00:00"), (2, "A", "x", None, "2024-01-01 11:00:00")])
    assert landing.clean_reviews(rows).count() == 0
    assert [r["review_id"] for r in landing.clean_reviews(rows, drop_missing_first=True).collect()] == [1]


def test_repeats_of_reviews_with_text_ids(spark):
    page = [("b2", "A", "x", 5, "2024-01-01 10:00:00"), ("b1", "A", "x", 4, "2024-01-01 10:00:00"), ("b0", "A", "x", 3, "2024-01-01 09:59:59")]
    rows = spark.createDataFrame(page, "review_id string, bank string, content string, score int, t string")
    for kind in ("timestamp", "timestamp_ntz"):
        got = landing.clean_reviews(rows.withColumn("review_ts", F.col("t").cast(kind))).collect()
        assert [(r["review_id"], r["rating"]) for r in got] == [("b1", 4)]


def test_an_ingest_has_no_cap(spark):
    page = [(i, "A", f"text {i}", 5, "2024-01-01 10:00:00") for i in range(1_001)]
    banks = spark.createDataFrame([("A",)], "name string")
    assert ingest(raw(spark, page), banks).cleaned.count() == 1_001
    assert ingest(raw(spark, page), banks, max_reviews=10).cleaned.count() == 10


def test_newest_reviews_and_volumes(spark):
    rows = raw(spark, [(i, "hot" if i % 3 else "cold", "t", 5, f"2024-01-01 00:{i % 60:02d}:00") for i in range(300)])
    got = landing.newest_reviews(rows, 7)
    assert {r["bank"]: r["count"] for r in got.groupBy("bank").count().collect()} == {"hot": 7, "cold": 7}
    assert {r["review_id"] % 60 for r in got.where("bank = 'hot'").collect()} == {59, 58}
    banks = spark.createDataFrame([("hot",), ("cold",), ("none",)], "name string")
    volumes = {r["bank"]: (r["n"], r["ok"]) for r in landing.volume_check(got, banks, 5).collect()}
    assert volumes == {"hot": (7, True), "cold": (7, True), "none": (0, False)}


def test_combine(spark):
    got = landing.combine([spark.range(2).select("id"), spark.range(1).withColumn("x", F.lit(1))])
    assert got.count() == 3 and got.where("x is null").count() == 2
    with pytest.raises(ValueError):
        landing.combine([])


def scored_rows(spark, rows):
    return spark.createDataFrame(rows, "bank string, sentiment_label string, themes array<string>")


INSIGHT_ROWS = (
    [("A", "positive", ["x", "y"])] * 3 + [("A", "positive", ["z"])] * 3 + [("A", "negative", ["y"])] + [("A", "neutral", ["x"])] * 9
    + [("B", "negative", ["q"])] + [("A", "positive", [])] + [(None, "positive", ["x"])] + [("C", None, ["x"])]
)


def test_top_themes(spark):
    df = scored_rows(spark, INSIGHT_ROWS)
    got = {(r["bank"], r["sentiment_label"], r["rank"]): (r["theme"], r["count"]) for r in insights.top_themes(df, 2).collect()}
    assert got == {
        ("A", "positive", 1): ("x", 3),
        ("A", "positive", 2): ("y", 3),
        ("A", "negative", 1): ("y", 1),
        ("B", "negative", 1): ("q", 1),
    }
    summary = insights.theme_summary(df)
    assert summary.where("sentiment_label = 'neutral'").first()["count"] == 9
    assert insights.theme_weights(summary, "positive").count() == 3
    assert insights.largest_themes(summary, "A", "positive", 1).first()["theme"] == "x"


def test_report_rows(spark):
    df = scored_rows(spark, INSIGHT_ROWS)
    side = {(r["bank"], r["rank"]): tuple(r)[2:] for r in insights.driver_pain_table(df, 3).collect()}
    assert side[("A", 1)] == ("x", "3", "y", "1") and side[("A", 2)] == ("y", "3", "", "") and side[("B", 1)] == ("", "", "q", "1")
    lines = [r["line"] for r in insights.report_lines(df, 1).where("bank = 'A'").orderBy("line_no").collect()]
    assert lines == ["📌 Insights for A", "", "✅ Top Drivers (Positive Themes):", "   - x (3)", "", "❌ Top Pain Points (Negative Themes):", "   - y (1)"]
    assert insights.report_lines(df, 1).where("bank = 'C'").count() == 5
    tree = {r["bank"]: r for r in insights.insight_tree(df, 1).collect()}
    assert [tuple(t) for t in tree["A"]["top_drivers"]] == [("x", 3)] and tree["B"]["top_drivers"] == []


def test_bank_ids_are_dense_and_stable(spark):
    names = spark.range(1000).select(F.concat(F.lit("bank"), F.col("id")).alias("name"))
    empty = spark.createDataFrame([], schemas.BANKS)
    banks = ops.upsert_banks(empty, names.unionByName(names))
    ids = {r["name"]: r["id"] for r in banks.collect()}
    assert sorted(ids.values()) == list(range(1, 1001))
    stored = spark.createDataFrame(banks.collect(), schemas.BANKS)
    more = ops.upsert_banks(stored, names.unionByName(spark.createDataFrame([("new",), (None,)], "name string")))
    grown = {r["name"]: r["id"] for r in more.collect()}
    assert grown.pop("new") == 1001 and grown == ids


def facts_of(spark, rows):
    full = [(b, t, r, d, "s", t, "positive", 0.9, ["k"], ["T"]) for b, t, r, d in rows]
    names = "bank string, review_text string, rating string, date string, source string, cleaned_text string, sentiment_label string, sentiment_score double, keywords array<string>, themes array<string>"
    return ops.typed_facts(spark.createDataFrame(full, names))


def test_typed_facts_and_keys(spark):
    got = facts_of(spark, [("A", "x", "4.5", "2024-01-01"), ("A", "x", "12", "soon"), ("A", "", None, None), ("A", None, None, None)]).collect()
    assert [str(r["rating"]) for r in got] == ["4.5", "None", "None", "None"]
    assert [str(r["review_date"]) for r in got] == ["2024-01-01", "None", "None", "None"]
    assert got[0]["themes"] == '["T"]' and len({r["id"] for r in got}) == 4


def test_load_audit_and_cascade(spark):
    banks = spark.createDataFrame([(1, "A"), (2, "B")], "id long, name string").withColumn("created_at", F.current_timestamp())
    facts = facts_of(spark, [("A", "x", "4", "2024-01-01"), ("B", "y", "2", "2024-01-01"), ("?", "z", "1", "2024-01-01")])
    assert [r["review_text"] for r in ops.unknown_banks(facts, banks).collect()] == ["z"]
    assert ops.known_banks(facts, banks).count() == 2
    rows = ops.with_bank_ids(facts, banks)
    assert ops.audit_warehouse(banks, rows).count() == 0
    broken = rows.unionByName(rows.withColumn("bank_id", F.lit(9).cast("long"))).unionByName(rows.withColumn("review_text", F.lit(None).cast("string")))
    rules = {(r["rule"], r["n"]) for r in ops.audit_warehouse(banks.unionByName(banks.withColumn("id", F.lit(7).cast("long"))), broken).collect()}
    assert rules == {
        ("banks.id primary key", 2),
        ("banks.name unique", 2),
        ("reviews.id primary key", 3),
        ("reviews.review_text not null", 2),
        ("reviews.bank_id foreign key", 2),
    }
    kept_banks, kept = ops.without_banks(rows, banks, spark.createDataFrame([("A",)], "name string"))
    assert [r["name"] for r in kept_banks.collect()] == ["B"] and [r["review_text"] for r in kept.collect()] == ["y"]
    report = ops.report_extract(rows, banks)
    assert report.columns == ["bank_name", "review_text", "rating", "review_date", "sentiment_label", "keywords", "themes"]
    assert report.count() == 2 and ops.report_extract(rows.withColumn("themes", F.lit("")), banks).count() == 0
    folder = fresh_path(spark, "warehouse")
    banks.write.parquet(f"{folder}/banks")
    rows.write.parquet(f"{folder}/reviews")
    assert warehouse.read_report(spark, folder).count() == 2


def test_repeated_load_appends_nothing(spark):
    path = fresh_path(spark, "facts")
    first = facts_of(spark, [("A", "x", "4", "2024-01-01"), ("A", "x", "4", "2024-01-01")])
    warehouse.append_facts(first, path)
    warehouse.append_facts(first, path)
    warehouse.append_facts(facts_of(spark, [("A", "x", "4", "2024-01-01"), ("B", "n", "4", "2024-01-01")]), path)
    assert spark.read.parquet(path).count() == 2
    undated = facts_of(spark, [("A", "x", "4", None), ("A", "y", "4", "2024-03-05")])
    for _ in range(2):
        warehouse.append_facts(undated, path)
    assert spark.read.parquet(path).count() == 4


def test_jdbc_options():
    options = warehouse.jdbc_options("jdbc:example:x", ("2020-01-01", "2024-12-31"), 8, user="u")
    assert options["partitionColumn"] == "review_date" and options["upperBound"] == "2024-12-31" and options["numPartitions"] == "8"
    assert "JOIN BANKS" in options["dbtable"] and "IS NOT NULL" in options["dbtable"] and options["user"] == "u"


def test_files(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 'say "hi",\nnew line', ["it's", 'a "b"'], " pad "), (2, None, [], "")], "id int, t string, l array<string>, p string"
    )
    files.write_csv(rows, f"{tmp_path}/c")
    back = files.text_as_lists(files.load(spark, "c", "csv", base_path=str(tmp_path), schema="id int, t string, l string, p string"), ["l"])
    assert sorted(map(tuple, back.collect())) == [(1, 'say "hi",\nnew line', ["it's", 'a "b"'], " pad "), (2, None, [], None)]
    assert files.read_csv(spark, f"{tmp_path}/c").schema["id"].dataType.typeName() == "integer"
    with pytest.raises(ValueError, match="excel"):
        files.load(spark, "x", "excel")
    with pytest.raises(Exception):
        files.load(spark, f"{tmp_path}/absent", "parquet")
    files.write_per_bank(spark.createDataFrame([("A", 1), ("B", 2)], "bank string, x int"), f"{tmp_path}/p")
    one = spark.read.parquet(f"{tmp_path}/p").where("bank = 'A'")
    assert "PartitionFilters: [isnotnull(bank" in one._jdf.queryExecution().toString() and one.count() == 1


def test_catalog_listing(spark):
    spark.range(1).selectExpr("id", "'x' as note").createOrReplaceTempView("listed_view")
    got = [tuple(r) for r in warehouse.list_columns(spark).where("table_name = 'listed_view'").collect()]
    assert got == [("listed_view", "TEMPORARY", "id", "bigint"), ("listed_view", "TEMPORARY", "note", "string")]


# Reviews of the scoring chain.
REVIEWS = [
    (1, "I can't log in to my account. Very frustrating!", 1),
    (2, "Great app! Love the new design and features. 😍", 5),
    (3, "Slow transactions and poor support response.", 2),
    (4, "😀", 5),
    (5, "the and of", 3),
    (6, None, 3),
]


def test_scoring_chain(spark):
    rows = spark.createDataFrame(REVIEWS, "review_id long, review string, rating int")
    got = {r["review_id"]: r for r in enrich_reviews(rows).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert {"review_text", "cleaned_text", "sentiment_label", "sentiment_score", "keywords", "themes"} <= set(got[1].asDict())
    assert got[2]["sentiment_label"] == "positive" and got[1]["sentiment_label"] == "negative"
    assert got[2]["cleaned_text"].endswith("love") and got[4]["cleaned_text"] == "happy"
    assert all(r["themes"] and 0 <= r["sentiment_score"] <= 1 and len(r["keywords"]) <= 5 for r in got.values())
    late = {r["review_id"] for r in enrich_reviews(rows, emoji_first=False).collect()}
    assert late == {1, 2, 3}


def test_pipeline_on_a_file_with_a_review_column_alone(spark, tmp_path):
    reviews = spark.createDataFrame([(r[1],) for r in REVIEWS], "review string")
    files.write_csv(reviews, f"{tmp_path}/in.csv")
    got = {r["review_text"]: r for r in run_pipeline(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out.csv").collect()}
    assert set(got) == {r[1] for r in REVIEWS[:4]}
    assert list(got["😀"].asDict()) == ["review_text", "cleaned_text", "sentiment_label", "sentiment_score", "keywords", "themes"]
    assert got[REVIEWS[1][1]]["sentiment_label"] == "positive" and got[REVIEWS[2][1]]["sentiment_label"] in ("neutral", "negative", "positive")
    assert all(r["themes"].startswith("[") for r in got.values())
    rated = spark.createDataFrame([r[1:] for r in REVIEWS], "review string, rating int")
    rated.write.parquet(f"{tmp_path}/in")
    assert run_pipeline(spark, f"{tmp_path}/in", f"{tmp_path}/out").count() == 4


def test_the_newest_version_of_a_fact_is_loaded(spark):
    rows = spark.createDataFrame([("a", "old", "2024-01-01"), ("a", "new", "2024-02-01"), ("b", "x", None)], "id string, v string, created_at string")
    got = ops.new_facts(rows, rows.where("id = 'none'")).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [("a", "new"), ("b", "x")]


def test_explore(spark):
    rows = spark.createDataFrame(
        [
            ("r1", "this is the english text 😀", 5, "2024-01-01 10:00:00", None, "u"),
            ("r2", "ceci est le texte français", 4, "2024-01-02", None, "u"),
            ("r3", None, 4, "2024-01-02", None, "u"),
            ("r1", "this is the english text 😀", 5, "2024-01-01 10:00:00", None, "u"),
        ],
        "reviewId string, content string, score int, at string, replyContent string, userName string",
    )
    texts = [("en", "this is the english text of the bank"), ("fr", "ceci est le texte français de la banque")]
    profiles = train_profiles(spark.createDataFrame(texts, "lang string, t string"), "t", "lang", ["en", "fr"])
    got = explore(rows, "A", profiles, ["en", "fr"])
    assert got.columns == ["review", "rating", "date", "userName", "bank", "source"]
    assert [r["review"] for r in got.collect()] == ["this is the english text happy"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_streams(spark):
    rows = raw(spark, PAGE).withColumn("review_ts", F.col("review_ts").cast("timestamp"))
    folder = fresh_path(spark, "pages")
    rows.where("review_id <= 2").coalesce(1).write.parquet(folder)
    out, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "checkpoint")

    def run():
        stream = jobs.read_landing(spark, folder, rows.schema)
        jobs.append_stream(jobs.first_arrivals(stream, ["bank", "content"], "review_ts"), out, checkpoint).awaitTermination()
        return sorted(r["review_id"] for r in spark.read.parquet(out).collect())

    assert run() == [1, 2]
    rows.where("review_id > 2").write.mode("append").parquet(folder)
    assert run() == [1, 2, 4, 5]  # row 3 repeats row 1
    assert run() == [1, 2, 4, 5]

    labelled = jobs.read_landing(spark, folder, rows.schema).withColumn("sentiment_label", F.when(F.col("score") > 3, "positive"))
    weeks = fresh_path(spark, "weeks")
    jobs.replace_table(jobs.weekly_sentiment(labelled), weeks, fresh_path(spark, "checkpoint")).awaitTermination()
    assert [(str(r[0]), r[1], r[2]) for r in spark.read.parquet(weeks).collect()] == [("2024-01-07", "positive", 3)]


def test_only_facts_whose_id_may_repeat_are_ordered(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("b", 2, "z"), (None, 1, "n")], "id string, created_at int, text string")
    new = ops.new_facts(rows, rows.where("id = 'a'"))
    assert sorted(map(tuple, new.collect()), key=str) == sorted([("b", 2, "z"), (None, 1, "n")], key=str)
    assert "_mark" in new._jdf.queryExecution().optimizedPlan().toString()
