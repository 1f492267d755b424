"""Every registered query beside its SQL in DuckDB, and what registration promises."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalogue.registry import ORACLES, QUERIES
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert compare(rows, df.columns, result.fetchall(), columns) is None


@pytest.mark.parametrize("name", ["stream_weekly_counts", "stream_first_arrivals", "text_to_timestamp", "weekly_sentiment"])
def test_time_zone_of_the_session_does_not_matter(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query_equals_sql(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["bank", "sentiment_label", "theme", "count", "rank"] and df.count() > 0


def test_top_themes_rank_only_counts(spark):
    plan = QUERIES["top_themes_per_bank"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
