"""Quantiles, top rows and lookups against brute force, with one group holding most rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import distributions, quantiles, trends
from revlens.operators.quantiles import box_stats, group_quantiles
from revlens.operators.joins import hot_keys, spread_join
from revlens.operators.topk import top_per_group

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    groups = np.where(rng.random(60_000) < 0.7, "hot", np.where(rng.random(60_000) < 0.5, "mid", "small"))
    groups[:3] = "few"
    groups[3] = "single"
    values = np.round(np.exp(rng.normal(3, 2, 60_000)), 2)
    values[::5] = 7.0  # a third-sized lump of one value
    rows = [(i, str(g), float(v)) for i, (g, v) in enumerate(zip(groups, values))]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(16), groups, values


def test_quantiles_are_exact(skewed):
    df, groups, values = skewed
    got = {r["g"]: r for r in group_quantiles(df, ["g"], "v", PROBS).collect()}
    assert set(got) == set(groups)
    for g in set(groups):
        own = values[groups == g]
        assert got[g]["n"] == len(own)
        np.testing.assert_allclose(got[g]["quantiles"], np.quantile(own, PROBS), rtol=1e-12)


def test_box_stats(skewed):
    df, groups, values = skewed
    for row in box_stats(df, ["g"], "v").collect():
        own = values[groups == row["g"]]
        q1, median, q3 = np.quantile(own, (0.25, 0.5, 0.75))
        inside = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
        assert (row["n_outliers"], row["whisker_low"], row["whisker_high"]) == (len(own) - len(inside), inside.min(), inside.max())
        assert row["median"] == pytest.approx(median)


def test_quantiles_skip_missing_groups_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("a", 3.0)], "g string, v double")
    rows = group_quantiles(df, ["g"], "v", [0.5]).collect()
    assert [(r["g"], r["n"], r["quantiles"]) for r in rows] == [("a", 1, [3.0])]


@pytest.mark.parametrize("spread", [False, True])
def test_top_per_group(skewed, spread):
    df, groups, values = skewed
    got = top_per_group(df, ["g"], [F.desc("v"), F.col("id")], 10, spread=spread, slices=3).collect()
    assert all("_slice" not in r.asDict() for r in got[:1])
    for g in set(groups):
        ids = np.flatnonzero(groups == g)
        wanted = sorted(ids, key=lambda i: (-values[i], i))[:10]
        assert [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == wanted


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, how):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "k string, x int")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select("k")
    wanted = sorted(map(str, facts.join(lookup, "k", how).collect()))
    for spread_on in (None, "id"):
        assert sorted(map(str, spread_join(facts, lookup, ["k"], how, spread_on=spread_on).collect())) == wanted


def test_building_a_plan_starts_no_job(spark):
    facts = spark.range(10).select("id", (F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    group = "plans-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        box_stats(facts, ["g"], "v")
        spread_join(facts, facts.select("g").distinct(), ["g"], spread_on="id")
        distributions.score_density(facts, "g", "v")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_value_that_is_nearly_all_of_a_group(spark):
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).otherwise(7.0).alias("v"))
    values = np.array([r["v"] for r in df.collect()])
    got = group_quantiles(df, ["g"], "v", PROBS).first()["quantiles"]
    assert got == pytest.approx(np.quantile(values, PROBS).tolist(), abs=1e-9)
    box = box_stats(df, ["g"], "v").first()
    assert box["n"] == 20_000 and box["median"] == 7.0 and box["n_outliers"] == int((values != 7.0).sum())


def test_quantiles_whatever_the_spread(spark):
    """An outlier, infinities and few rows leave quantiles exact; only values near a quantile are ordered."""
    even = spark.range(1, 100_001).select(F.lit("far").alias("g"), F.col("id").cast("double").alias("v"))
    rows = even.union(spark.createDataFrame([("far", 1e12), ("inf", 1.0), ("inf", 2.0), ("inf", float("inf")), ("inf", float("-inf")), ("one", 3.0), ("all", float("inf")), ("all", float("inf"))], "g string, v double"))
    got = {r["g"]: r for r in group_quantiles(rows, ["g"], "v", PROBS).collect()}
    values = np.append(np.arange(1.0, 100_001.0), 1e12)
    assert got["far"]["quantiles"] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12) and got["far"]["max_value"] == 1e12
    assert set(got["one"]["quantiles"]) == {3.0} and set(got["all"]["quantiles"]) == {float("inf")}
    assert group_quantiles(rows.where("g = 'inf'"), ["g"], "v", (0.5,)).first()["quantiles"] == [1.5]
    box = {r["g"]: r for r in box_stats(rows, ["g"], "v").collect()}
    assert box["far"]["n_outliers"] == 1 and box["far"]["whisker_high"] == 100_000.0


def test_a_wrong_sketch_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), F.pow(F.col("id") % 977, F.lit(2)).cast("double").alias("v"))
    local = rows.toPandas()
    for r in group_quantiles(rows, ["g"], "v", PROBS).collect():
        assert r["quantiles"] == pytest.approx(np.quantile(local[local.g == r["g"]].v, PROBS).tolist(), abs=1e-9)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_are_sliced_alone(spark, how):
    """One key of nine rows in ten, and null keys."""
    facts = spark.range(3000).select("id", F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 100 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 450)).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("k10", 2), ("zz", 3)], "k string, x int")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select("k")
    hot = hot_keys(facts, ["k"])
    marks = {r[0]: r[1] for r in facts.select("k", F.xxhash64("k")).distinct().collect()}
    assert marks["hot"] in hot and len(hot) < len(marks)
    found = spread_join(facts, lookup, ["k"], how, spread_on="id", hot=hot)
    assert sorted(map(str, found.collect())) == sorted(map(str, facts.join(lookup, "k", how).collect()))
    assert "_slice" not in found.columns


def test_a_plan_without_hot_keys_repeats_no_lookup(spark):
    facts = spark.range(5000).select("id", (F.col("id") % 2500).cast("string").alias("k"))
    lookup = spark.range(2500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("x"))
    assert hot_keys(facts, ["k"]) == []
    plan = spread_join(facts, lookup, ["k"], spread_on="id", hot=hot_keys(facts, ["k"]))._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan.lower()


def test_histogram_has_every_bin(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("a", 0.55), ("b", 0.1), ("b", None), ("c", -2.0), ("c", 1.5)], "bank string, s double")
    rows = {(r["bank"], r["bin"]): r["count"] for r in distributions.score_histogram(df, "bank", "s", 10).collect()}
    assert len(rows) == 36
    assert {k: v for k, v in rows.items() if v} == {("a", 1): 1, ("a", 6): 1, ("a", 10): 1, ("b", 2): 1, ("c", 0): 1, ("c", 11): 1}


def test_density_integrates_to_one(spark):
    df = spark.range(500).select(F.lit("a").alias("bank"), (0.4 + (F.col("id") % 100) / 500).alias("s"))
    got = distributions.score_density(df, "bank", "s", points=101).collect()
    assert sum(r["density"] for r in got) / 100 == pytest.approx(1.0, abs=0.02)


def test_daily_mean_shows_gaps(spark):
    df = spark.createDataFrame([("2024-01-01", 5), ("2024-01-01", 2), ("2024-01-04", 1), (None, 3)], "date string, rating int")
    got = [tuple(r) for r in trends.daily_mean_rating(df).selectExpr("string(day)", "mean_rating", "n").orderBy("day").collect()]
    assert got == [("2024-01-01", 3.5, 2), ("2024-01-02", None, 0), ("2024-01-03", None, 0), ("2024-01-04", 1.0, 1)]


def test_weekly_and_daily_sentiment(spark):
    df = spark.createDataFrame(
        [("2024-01-07", "positive"), ("2024-01-08", "negative"), ("2024-01-08", "positive"), ("2024-01-29", "neutral"), ("2024-01-08", None), ("2024-01-08", "mixed")],
        "date string, sentiment_label string",
    ).withColumn("date", F.to_date("date"))
    weeks = {str(r[0]): tuple(r)[1:] for r in trends.weekly_sentiment(df).collect()}
    assert weeks == {"2024-01-07": (0, 0, 1, 0), "2024-01-14": (1, 0, 1, 1), "2024-02-04": (0, 1, 0, 0)}
    days = {str(r[0]): tuple(r)[1:] for r in trends.daily_sentiment(df).collect()}
    assert days["2024-01-08"] == (1, 0, 1, 1) and len(days) == 3


def test_box_stats_meet_no_whole_group_in_one_task(spark):
    rows = spark.range(1_000).selectExpr("id % 3 AS g", "id * 0.5 AS v")
    boxes = box_stats(rows, ["g"], "v")
    joins = [line for line in boxes._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in line]
    assert joins and all("_slice" in line for line in joins)
    assert sorted((r.g, r.median, r.n_outliers) for r in boxes.collect()) == [(0, 249.75, 0), (1, 249.5, 0), (2, 250.0, 0)]
