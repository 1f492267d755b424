"""Column-level operators. All but `drop_empty_columns` only rewrite the plan."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from revlens.functions.dates import parse_timestamp, parse_timestamp_strict

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job starts when a needed column is absent."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    names = list(names)
    absent = [name for name in names if name not in df.columns]
    if absent:
        log.warning("columns not found, ignored: %s", absent)
    return [name for name in names if name in df.columns]


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; warn about the others."""
    return df.withColumnsRenamed({old: mapping[old] for old in _present(df, mapping)})


def rename_first(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename, and put the renamed columns in front in the mapping's order."""
    front = [mapping[old] for old in _present(df, mapping)]
    renamed = rename_columns(df, mapping)
    return renamed.select(*front, *[name for name in renamed.columns if name not in front])


def constant_columns(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def tidy_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case column names, blanks become underscores."""
    return df.toDF(*[name.strip().lower().replace(" ", "_") for name in df.columns])


def drop_redundant_columns(df: DataFrame) -> DataFrame:
    """Drop the exported index column and every repeat of a column name."""
    names = df.columns
    unique = df.toDF(*[f"c{i}" for i in range(len(names))])
    kept: dict[str, str] = {}
    for i, name in enumerate(names):
        if name != "unnamed:_0":
            kept.setdefault(name, f"c{i}")
    return unique.select(*[F.col(source).alias(name) for name, source in kept.items()])


def tidy_columns(df: DataFrame) -> DataFrame:
    return df.transform(tidy_names).transform(drop_redundant_columns)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*_present(df, names))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: NaN becomes NULL, so that grouping treats both alike."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: F.nanvl(F.col(f"`{name}`"), F.lit(None)) for name in floats})


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value.

    The result's schema depends on the data, so this runs one aggregation at once.
    """
    filled = df.agg(*[F.max(~is_missing(df, name)).alias(f"c{i}") for i, name in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{name}`") for i, name in enumerate(df.columns) if filled[f"c{i}"]])


def date_like_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if "date" in name.lower() or "time" in name.lower()]


def to_timestamps(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    errors: str = "coerce",
    formats: Sequence[str] = (),
) -> DataFrame:
    """Text columns to UTC timestamps. Without a list, every column named like a date or time."""
    if errors not in ("coerce", "raise"):
        raise ValueError(f"errors must be 'coerce' or 'raise', not {errors!r}")
    names = date_like_columns(df) if columns is None else _present(df, columns)
    convert = parse_timestamp_strict if errors == "raise" else lambda c: parse_timestamp(c, formats)
    return df.withColumns({name: convert(F.col(f"`{name}`").cast("string")) for name in names})


def timestamp_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: values present before the conversion, converted, lost."""
    names = date_like_columns(df) if columns is None else _present(df, columns)
    raw = {name: F.col(f"`{name}`").cast("string") for name in names}
    counts = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(text).alias("n_before"),
                F.count(parse_timestamp(text)).alias("n_converted"),
            ).alias(f"c{i}")
            for i, (name, text) in enumerate(raw.items())
        ]
    )
    rows = counts.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(names))])).alias("r")).select("r.*")
    return rows.withColumn("n_lost", F.col("n_before") - F.col("n_converted"))


def prepare_for_charts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Check the columns, read the date, drop rows without a date or a review."""
    return require_columns(df, required).transform(to_timestamps, ["date"]).dropna(subset=["date", "review"])
