"""Streams that break between batches and go on, and rows that come after the watermark."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException

from revlens.session import fresh_path
from revlens.streaming import jobs

SCHEMA = "user long, kind string, ts timestamp"
# Three files: days 0-20, days 14-34, then days 30-55 with one row of day 2 that is long late.
BATCHES = [range(0, 21), range(14, 35), [*range(30, 56), 2]]


def land(spark, folder, number):
    rows = [(day % 5, f"k{day % 2}", datetime(2024, 1, 1, 12) + timedelta(days=day)) for day in BATCHES[number]]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def expected(batches):
    counts = {}
    for day in (d for b in batches for d in b):
        key = (date(2024, 1, 7) + timedelta(days=day // 7 * 7), f"k{day % 2}")
        counts[key] = counts.get(key, 0) + 1
    return counts


def test_state_is_kept_on_disk(spark):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_a_batch_that_breaks_runs_again(spark):
    """Broken after it wrote and before that was recorded: the version is written anew."""
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landed", "versions", "checkpoint"))

    def counts():
        return jobs.weekly_counts(jobs.read_landing(spark, folder, spark.createDataFrame([], SCHEMA).schema), "ts", "kind")

    def breaks(batch, _):
        batch.write.parquet(f"{path}/version=broken")
        raise RuntimeError("lost")

    for number in range(3):
        land(spark, folder, number)
        if number == 1:
            with pytest.raises(StreamingQueryException):
                jobs.for_each_batch(counts(), breaks, checkpoint, mode="complete").awaitTermination()
            found = jobs.read_table(spark, path)  # the version before still stands
            assert {(r.week_ending, r.kind): r["count"] for r in found.collect()} == expected(BATCHES[:1])
        jobs.replace_table(counts(), path, checkpoint).awaitTermination()
        found = jobs.read_table(spark, path)
        assert {(r.week_ending, r.kind): r["count"] for r in found.collect()} == expected(BATCHES[: number + 1])


def test_late_rows_change_no_week_that_is_out(spark):
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landed", "weeks", "checkpoint"))
    for number in range(3):
        land(spark, folder, number)
        stream = jobs.read_landing(spark, folder, spark.createDataFrame([], SCHEMA).schema)
        jobs.append_stream(jobs.weekly_counts(stream, "ts", "kind"), path, checkpoint).awaitTermination()
    out = [((r.week_ending, r.kind), r["count"]) for r in spark.read.parquet(path).collect()]
    whole = expected([*BATCHES[:2], range(30, 56)])
    over = {key: n for key, n in whole.items() if key[0] + timedelta(days=8) <= date(2024, 1, 1) + timedelta(days=55)}
    assert len(out) == len(dict(out)) and dict(out) == over


def test_first_arrivals_over_restarts(spark):
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landed", "first", "checkpoint"))
    for number in range(3):
        land(spark, folder, number)
        stream = jobs.read_landing(spark, folder, spark.createDataFrame([], SCHEMA).schema)
        jobs.append_stream(jobs.first_arrivals(stream, ["user", "ts"], "ts"), path, checkpoint).awaitTermination()
    days = sorted((r.ts - datetime(2024, 1, 1, 12)).days for r in spark.read.parquet(path).collect())
    assert days == list(range(56))  # day 2 of the last file is late and does not come twice
