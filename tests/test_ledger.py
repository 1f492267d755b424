"""Recorded loads and versions: repeated, broken and overlapping writes, and reads while a table is replaced."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from revlens.session import fresh_path
from revlens.sources import ledger, warehouse
from revlens.streaming import jobs


def facts(spark, *days):
    return spark.createDataFrame([(f"f{d}", "A", d) for d in days], "id string, bank string, day string").select("id", "bank", F.to_date("day").alias("review_date"))


def ids(spark, path):
    return sorted(r.id for r in warehouse.read_facts(spark, path).collect())


def folders(spark, path):
    return {r.name: f"{path}/load={r.name}" for r in ledger.records(spark, path).collect()}


@pytest.mark.parametrize("dated", [True, False])
def test_a_recorded_load_meets_no_stored_fact(spark, dated):
    path = fresh_path(spark, "facts")
    load = facts(spark, "2024-01-01", "2024-02-03", "2024-02-04")
    load = load if dated else load.drop("review_date")
    assert ids(spark, path) == [] and warehouse.append_facts(load, path)
    before = ids(spark, path)
    (folder,) = folders(spark, path).values()
    kept = spark.read.parquet(folder).toPandas()
    spark.createDataFrame([("not facts",)], "x string").write.mode("overwrite").text(folder)  # whoever reads it now fails or finds nothing
    assert not warehouse.append_facts(load.repartition(3).orderBy(F.desc("id")), path)
    assert len(kept) == len(before) == 3
    assert [r.n_rows for r in ledger.records(spark, path).collect()] == [3]


def test_loads_that_overlap_and_empty_loads(spark):
    path = fresh_path(spark, "facts")
    assert warehouse.append_facts(facts(spark, "2024-01-01", "2024-02-03"), path)
    assert warehouse.append_facts(facts(spark, "2024-02-03", "2024-02-09", "2024-02-09"), path)
    assert not warehouse.append_facts(facts(spark, "2024-02-09"), path)  # nothing new, but a load of its own
    assert not warehouse.append_facts(facts(spark, "2024-01-01").limit(0), path)
    assert ids(spark, path) == ["f2024-01-01", "f2024-02-03", "f2024-02-09"]
    assert sorted(r.n_rows for r in ledger.records(spark, path).collect()) == [0, 1, 2]


def test_a_broken_load_is_not_read_and_is_written_anew(spark, monkeypatch):
    path, landed, checkpoint = (fresh_path(spark, n) for n in ("facts", "landed", "checkpoint"))
    for day in ("2024-01-01", "2024-02-03"):
        facts(spark, day).coalesce(1).write.mode("append").parquet(landed)

    def run():
        stream = jobs.read_landing(spark, landed, spark.read.parquet(landed).schema, per_batch=1)
        jobs.load_facts(stream, lambda batch: batch, path, checkpoint).awaitTermination()

    real, calls = ledger.record, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost between the facts and their record")
        real(*args)

    monkeypatch.setattr(ledger, "record", breaks)
    with pytest.raises(StreamingQueryException):
        run()
    assert len(ids(spark, path)) == 1  # the second load's folder is there, its record is not
    run()
    assert ids(spark, path) == ["f2024-01-01", "f2024-02-03"]
    run()
    assert ids(spark, path) == ["f2024-01-01", "f2024-02-03"] and ledger.records(spark, path).count() == 2


def test_a_reader_keeps_its_version(spark):
    path, landed, checkpoint = (fresh_path(spark, n) for n in ("weeks", "landed", "checkpoint"))

    def run():
        stream = jobs.read_landing(spark, landed, "ts timestamp, label string", per_batch=1)
        jobs.replace_table(jobs.weekly_counts(stream, "ts", "label"), path, checkpoint).awaitTermination()

    def land(*days):
        spark.createDataFrame([(d, "x") for d in days], "day string, label string").select(F.to_timestamp("day").alias("ts"), "label").coalesce(1).write.mode("append").parquet(landed)

    with pytest.raises(ValueError):
        jobs.read_table(spark, path)
    land("2024-01-01", "2024-01-02")
    run()
    old = jobs.read_table(spark, path)
    for days in (("2024-01-03",), ("2023-12-31", "2024-01-10"), ("2024-01-04",)):  # three more batches, restarts between them
        land(*days)
        run()
    assert [r["count"] for r in old.collect()] == [2]
    assert sorted((str(r[0]), r[2]) for r in jobs.read_table(spark, path).collect()) == [("2023-12-31", 1), ("2024-01-07", 4), ("2024-01-14", 1)]
    assert ledger.records(spark, path).count() == 4
