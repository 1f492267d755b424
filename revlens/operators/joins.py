"""Joins of many fact rows to one lookup row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SLICES = 32
# A key is hot if it may hold more than one in so many fact rows; the sketch follows this many keys.
HOT_SHARE, TRACKED = 200, 10_000


def hot_keys(facts: DataFrame, on: Sequence[str]) -> list[int]:
    """The marks of keys that may hold more than one of `HOT_SHARE` rows, by one pass of a sketch of the most frequent keys.

    Sketches of tasks are merged before they reach the driver. They never count too few, so no hot key is missed.
    """
    marked = facts.select(F.xxhash64(*on).alias("mark"))
    n, top = marked.agg(F.count("*"), F.expr(f"approx_top_k(mark, {2 * HOT_SHARE}, {TRACKED})")).first()
    return [entry["item"] for entry in top or [] if entry["count"] * HOT_SHARE > n]


def spread_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", spread_on: str | None = None, hot: Sequence[int] = ()) -> DataFrame:
    """Join facts to a lookup (inner, left, left_semi or left_anti).

    Without `hot` this is a plain join: the planner sees the lookup's true size and sends a small one whole, and the adaptive plan splits the
    partition of a key that turns out to hold much of the table. With `hot`, marks that `hot_keys` found, these keys are cut into slices by
    `spread_on`, a column that varies among the facts of one key, and only their lookup rows are repeated, for sessions without that plan
    and for joins that come before work the plan does not shuffle again.
    """
    on = list(on)
    if spread_on is None or not hot:
        return facts.join(lookup, on, how)
    mark, first = F.xxhash64(*on), F.lit(0).cast("long")
    sliced = facts.withColumn("_slice", F.when(mark.isin(list(hot)), F.pmod(F.xxhash64(spread_on), F.lit(SLICES))).otherwise(first))
    others = F.sequence(F.lit(1).cast("long"), F.lit(SLICES - 1).cast("long"))
    copies = lookup.withColumn("_slice", first).union(lookup.where(mark.isin(list(hot))).withColumn("_slice", F.explode(others)))
    return sliced.join(copies, [*on, "_slice"], how).drop("_slice")
