"""Exact quantiles per group.

A mergeable sketch brackets each quantile between two values whose ranks surely or almost surely enclose it; how many rows lie below and up to
a bracket is then counted exactly, and only the values inside it, a small share of the group, are ordered. A bracket
that the counts prove wrong becomes the group's whole range, so that results are exact whatever the sketch says. Rows are
counted per group and value first, so that equal values are one row before they move. Nothing depends on how values are spread.
Counts meet the facts of their group in slices, each with its own copy of the facts, so that no task sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

ACCURACY = 50_000
SLICES = 32


def _rows(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    return df.select(*group, F.col(value).cast("double").alias("_v")).dropna()


def _cells(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    slice_of = F.pmod(F.xxhash64("_v"), F.lit(SLICES)).cast("int")
    return rows.groupBy(*group, "_v").agg(F.count("*").alias("_c")).withColumn("_slice", slice_of)


def _with_facts(cells: DataFrame, facts: DataFrame, group: Sequence[str]) -> DataFrame:
    """The counts, each with the facts of its group."""
    copies = facts.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return cells.join(copies, [*group, "_slice"])


def _quantiles(rows: DataFrame, cells: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    reach = 2.0 / ACCURACY
    ends = [min(1.0, max(0.0, p + side * reach)) for p in probs for side in (-1, 1)]
    sketch = rows.groupBy(*group).agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", ends, ACCURACY).alias("_ends"),
    )
    counts = [F.sum(F.when(F.col("_v") < F.col("_ends")[2 * i], F.col("_c")).otherwise(0)).alias(f"_b{i}") for i in range(len(probs))]
    counts += [F.sum(F.when(F.col("_v") <= F.col("_ends")[2 * i + 1], F.col("_c")).otherwise(0)).alias(f"_u{i}") for i in range(len(probs))]
    facts = [*group, "_n", "_min", "_max"]
    counted = _with_facts(cells, sketch, group).groupBy(*facts, "_ends").agg(*counts)
    brackets = []
    for i, p in enumerate(probs):
        position = (F.col("_n") - 1) * float(p)
        first, last = F.floor(position), F.ceil(position)
        right = (F.col(f"_b{i}") <= first) & (last < F.col(f"_u{i}"))
        brackets.append(
            F.struct(
                F.lit(i).alias("i"),
                position.alias("position"),
                F.when(right, F.col("_ends")[2 * i]).otherwise(F.col("_min")).alias("low"),
                F.when(right, F.col("_ends")[2 * i + 1]).otherwise(F.col("_max")).alias("high"),
                F.when(right, F.col(f"_b{i}")).otherwise(F.lit(0).cast("long")).alias("below"),
            )
        )
    wanted = counted.select(*facts, F.array(*brackets).alias("_brackets"))
    met = _with_facts(cells, wanted, group).withColumn("_brackets", F.filter("_brackets", lambda b: (b["low"] <= F.col("_v")) & (F.col("_v") <= b["high"])))
    inside = met.where(F.size("_brackets") > 0).withColumn("_b", F.explode("_brackets")).select(*facts, "_v", "_c", "_b.*")
    upto = Window.partitionBy(*group, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("below") + F.sum("_c").over(upto)
    ranked = inside.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c"))

    def value_at(place):
        return F.max(F.when((F.col("_start") <= place) & (place < F.col("_end")), F.col("_v")))

    low, high, beyond = F.col("_low"), F.col("_high"), F.col("position") - F.floor("position")
    exact = F.when((low == high) | (beyond == 0), low).otherwise(low + (high - low) * beyond)
    pairs = ranked.groupBy(*facts, "i", "position").agg(value_at(F.floor("position")).alias("_low"), value_at(F.ceil("position")).alias("_high"))
    found = pairs.groupBy(*facts).agg(F.array_sort(F.collect_list(F.struct("i", exact.alias("x")))).alias("_x"))  # one entry per wanted quantile
    return found.select(*group, F.col("_n").alias("n"), F.col("_min").alias("min_value"), F.col("_max").alias("max_value"), F.transform("_x", lambda x: x["x"]).alias("quantiles"))


def group_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """One row per group: `n`, `min_value`, `max_value` and `quantiles`, an array in `probs` order.

    Quantiles interpolate linearly between neighbouring values. Rows with a NULL group or value are left out.
    """
    rows = _rows(df, group, value)
    return _quantiles(rows, _cells(rows, group), group, probs)


def box_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers inside 1.5 box lengths, outlier count.

    Quartiles, whiskers and outliers read the same counts. Infinite values lie outside a finite box.
    """
    rows = _rows(df, group, value)
    cells = _cells(rows, group)
    quartiles = _quantiles(rows, cells, group, (0.25, 0.5, 0.75)).select(
        *group,
        "n",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach)
    return (
        _with_facts(cells, quartiles, group)
        .groupBy(*group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("n_outliers"),
        )
    )
