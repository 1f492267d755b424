"""Records and rows that do not fit, and numbers in order at any size."""

import pytest
from pyspark.sql import functions as F

from revlens.operators.warehouse import dense_ids, in_order, upsert_banks
from revlens.session import fresh_path
from revlens.sources.files import read_csv_with_rejects
from revlens.sources.landing import of_unknown_apps, with_bank_names


def test_rejected_records_are_kept_as_they_stand(spark):
    path = fresh_path(spark, "damaged")
    lines = ["id,text,stars", "1,fine,5", "two,bad id,4", '3,"a ""quoted"", text",1', "4,few", "5,many,3,4", '6,"line\nbreak",2', "7,,", "8,half,4.5"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    rows, rejects = read_csv_with_rejects(spark, path, "id long, text string, stars int")
    assert {tuple(r) for r in rows.collect()} == {(1, "fine", 5), (3, 'a "quoted", text', 1), (6, "line\nbreak", 2), (7, None, None)}
    assert {r.record for r in rejects.collect()} == {"two,bad id,4", "4,few", "5,many,3,4", "8,half,4.5"}
    assert rejects.count() == 4 and rows.columns == ["id", "text", "stars"]


def test_a_column_named_like_the_record(spark):
    path = fresh_path(spark, "clash")
    spark.createDataFrame([("_record,n\nx,1\ny,z",)], "value string").coalesce(1).write.text(path)
    rows, rejects = read_csv_with_rejects(spark, path, "_record string, n int")
    assert [tuple(r) for r in rows.collect()] == [("x", 1)] and [r.record for r in rejects.collect()] == ["y,z"]


def test_unknown_apps_and_known_ones_are_all_rows(spark):
    raw = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "a")], "id long, app_id string")
    banks = {"a": "Bank A", "b": "Bank B"}
    known, unknown = with_bank_names(raw, banks), of_unknown_apps(raw, banks)
    assert {r.id for r in known.collect()} == {1, 2, 5} and {r.id for r in unknown.collect()} == {3, 4}


@pytest.mark.parametrize("tasks", [1, 13])
def test_numbers_in_order(spark, tasks):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("key"), (F.col("id") % 3).alias("other")).repartition(tasks)
    found = [(r.n, r.key) for r in in_order(rows, ["key"], "n").orderBy("key").collect()]
    assert [n for n, _ in found] == list(range(1, 20_001))
    hot = in_order(rows, ["other"], "n").collect()  # equal values: any order among them, all numbers once
    assert sorted(r.n for r in hot) == list(range(1, 20_001)) and [r.other for r in sorted(hot, key=lambda r: r.n)] == sorted(r.other for r in hot)


def test_dense_ids_leave_out_missing_keys_and_empty_tables(spark):
    names = spark.createDataFrame([("b",), (None,), ("a",)], "name string")
    assert sorted(r.id for r in dense_ids(names, "name", 10).collect()) == [11, 12]
    assert dense_ids(names.where("name = 'c'"), "name").collect() == []


def test_banks_go_on_from_the_last_number(spark):
    banks = spark.createDataFrame([(4, "old", None)], "id long, name string, created_at timestamp")
    names = spark.createDataFrame([(n,) for n in ("x", "old", "y", "x", None)], "name string")
    found = {r.name: r.id for r in upsert_banks(banks, names).collect()}
    assert found["old"] == 4 and {found["x"], found["y"]} == {5, 6} and len(found) == 3
