"""Streams over a long span of events that land as several files, beside the same counts in one batch."""

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalogue import streaming
from catalogue.registry import QUERIES
from revlens import schemas
from revlens.session import fresh_path


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_no_file_of_a_load_is_late_for_another(spark):
    folder = fresh_path(spark, "long-events")
    start = "timestamp_ntz'2024-01-01 00:00:00'"
    columns = ["id AS event_id", f"{start} + make_dt_interval(cast(id DIV 8 AS int), cast(id % 8 * 3 AS int)) AS ts", "id AS user_id", "concat('t', id % 3) AS event_type", "1.0D AS value", "'' AS props"]
    events = spark.range(8 * 100).selectExpr(*columns)
    # Each file has a part of the days, the newest first.
    events.withColumn("part", F.expr("pmod(-(event_id DIV 8), 4)")).repartitionByRange(4, "part").drop("part").write.parquet(f"{folder}/events.parquet")
    events = spark.read.parquet(f"{folder}/events.parquet")
    first = events.selectExpr("user_id", "event_type", "cast(cast(ts AS date) AS string) AS day")
    assert rows_of(QUERIES["stream_first_arrivals"](spark, folder)) == rows_of(first.distinct())
    weeks = events.groupBy(F.expr("cast(date_add(cast(date_trunc('week', ts) AS date), 6) AS string)").alias("week_ending"), "event_type").agg(F.count("*").alias("count"))
    assert rows_of(QUERIES["stream_weekly_counts_so_far"](spark, folder)) == rows_of(weeks)
    over = weeks.where(F.expr("date_add(cast(week_ending AS date), 8) <= date'2024-04-09'"))
    assert rows_of(QUERIES["stream_weekly_counts"](spark, folder)) == rows_of(over)


def test_stretches_are_no_longer_than_the_delay():
    first = datetime(2024, 1, 1)
    for days in (0, 1, 30, 42, 43, 400):
        last = first + timedelta(days=days)
        bounds = [first, *streaming._stretches(first, last), last]
        assert bounds == sorted(bounds) and len(bounds) >= 7
        assert all(b - a <= streaming.DELAY + timedelta(microseconds=1) for a, b in zip(bounds, bounds[1:], strict=False))


def test_documents_may_land_as_a_folder_of_files(spark):
    folder = fresh_path(spark, "documents-in-parts")
    rows = [(i, f"Great app {i}!", "en", f"src{i}", 12) for i in range(4)]
    spark.createDataFrame(rows, schemas.DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    assert [r[0] for r in rows_of(QUERIES["stream_ingest"](spark, folder))] == [0, 1, 2, 3]
    assert [r[0] for r in rows_of(QUERIES["stream_scores"](spark, folder))] == [0, 1, 2, 3]
    assert QUERIES["stream_fact_load"](spark, folder).count() == 4


def _landed(spark, in_parts):
    """Documents in one file or in a folder of three, with events and labels that rate them."""
    folder = fresh_path(spark, "landed")
    Path(folder).mkdir(parents=True)
    texts = ["Great app, love it!", "It is bad, it crashed again.", "love the great design", "Bad and slow, login fails", "nothing", "", None, "great but slow"]
    start = datetime(2024, 1, 1)
    tables = {
        "events": {"event_id": list(range(80)), "ts": [start + timedelta(hours=i) for i in range(80)], "user_id": [i // 10 for i in range(80)], "event_type": ["view"] * 80, "value": [1.0] * 80, "props": [""] * 80},
        "labels": {"doc_id": list(range(6)), "quality": [1, 0, 1, 0, 1, 0], "toxic": [0] * 6},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    documents = pa.table({"doc_id": list(range(8)), "text": texts, "lang": ["en"] * 8, "source": ["src1"] * 8, "n_chars": [len(t or "") for t in texts]})
    if in_parts:
        Path(f"{folder}/documents.parquet").mkdir()
        for i in range(3):
            pq.write_table(documents.slice(3 * i, 3), f"{folder}/documents.parquet/part-{i}.parquet")
    else:
        pq.write_table(documents, f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", ["stream_model_scores", "stream_scores"])
def test_scores_of_a_folder_of_files_equal_those_of_one_file(spark, name):
    one, parts = (rows_of(QUERIES[name](spark, _landed(spark, in_parts))) for in_parts in (False, True))
    assert parts == one and [r[0] for r in parts] == list(range(8)) and len({r[1] for r in parts}) > 1
