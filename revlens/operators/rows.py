"""Row filters and duplicate handling."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.text import is_blank
from revlens.operators.columns import _present

log = logging.getLogger(__name__)

_COPIES_PER_CHUNK = 100_000


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a missing value in any listed column that exists."""
    names = _present(df, columns)
    if not names:
        log.warning("no usable columns, no rows dropped")
        return df
    return df.dropna(how="any", subset=names)


def drop_blank_text(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_blank(column))


def scored_only(df: DataFrame, columns: Sequence[str] = ("sentiment_label", "themes")) -> DataFrame:
    """Rows whose listed text columns hold a value; empty text counts as missing."""
    for name in columns:
        df = df.where(F.nullif(F.col(name), F.lit("")).isNotNull())
    return df


def _number(df: DataFrame, column: str) -> Column:
    """A time, date or number as something that can be negated, the same in every session zone."""
    kind, value = dict(df.dtypes)[column], F.col(column)
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":
        seconds = F.unix_date(F.to_date(value)).cast("long") * 86_400 + F.hour(value) * 3_600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    return F.unix_date(value) if kind == "date" else value


def newest_per_key(df: DataFrame, keys: Sequence[str], newest: str, row_id: str) -> DataFrame:
    """One row per key: the newest, ties to the smallest id, whatever the id's type.

    Written as an aggregation so that copies collapse before the shuffle: a key holding a third of
    the table reaches its reducer as one row per map task. The leading hash keeps the sort on long
    text keys cheap.
    """
    others = [name for name in df.columns if name not in keys]
    # Of equal keys the first in this order is the newest with the smallest id; NULL times come last.
    rank = F.struct(F.col(newest).isNull().alias("_none"), (-_number(df, newest)).alias("_when"), F.col(row_id))
    return (
        df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)
        .agg(F.min_by(F.struct(*others), rank).alias("_row"))
        .select(*[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in df.columns])
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def duplicate_rows(df: DataFrame, keep: str | bool = "first") -> DataFrame:
    """The repeated rows themselves: all but the first (or last) of each group, or all of them.

    Rows of a group are equal in every column, so the group's count says what to emit. Large
    counts are cut into chunks and spread out before the copies are written.
    """
    _check_keep(keep)
    drop = 0 if keep is False else 1
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n > 1")
    chunks = groups.withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1 - drop, F.lit(_COPIES_PER_CHUNK).cast("long")))
    ).withColumn("_len", F.least(F.lit(_COPIES_PER_CHUNK), F.col("_n") - drop - F.col("_start")))
    copies = chunks.repartition(*df.columns, "_start").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_len"))))
    return copies.select(*df.columns)


def drop_duplicate_rows(df: DataFrame, keep: str | bool = "first") -> DataFrame:
    """One row per group of equal rows, or with `keep=False` only the rows that never repeat."""
    _check_keep(keep)
    if keep is not False:
        return df.dropDuplicates()
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")


def _check_keep(keep: str | bool) -> None:
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")


def step_report(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows before and after each filter, the filters applied in order, in one pass."""
    passed = F.lit(True)
    counts = []
    for name, condition in steps.items():
        before = F.count(F.when(passed, 1))
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.struct(F.lit(name).alias("step"), before.alias("n_before"), F.count(F.when(passed, 1)).alias("n_after")))
    rows = df.agg(F.array(*counts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return rows.withColumn("n_dropped", F.col("n_before") - F.col("n_after"))


def top_rows(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of an ordering: each task keeps `n`, the merge keeps `n` again."""
    return df.orderBy(*by).limit(n)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return top_rows(df, [F.asc_nulls_last(key)], n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return top_rows(df, [F.desc_nulls_last(key)], n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A random sample of exactly `n` rows that repeats for equal data and seed."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return top_rows(df, [draw, F.col(key)], n)
