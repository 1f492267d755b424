"""Data profiling: missing values, invalid markers, numeric and text summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from revlens.functions.text import percent_text, strip
from revlens.functions.vocab import INVALID_MARKERS
from revlens.operators.columns import is_missing
from revlens.operators.quantiles import group_quantiles
from revlens.operators.topk import top_per_group

SKETCH_LG = 12


def _per_column(df: DataFrame, expressions: dict[str, dict[str, object]]) -> DataFrame:
    """One aggregation over the table, turned into one row per column."""
    cells = [
        F.struct(F.lit(name).alias("column_name"), *[e.alias(key) for key, e in parts.items()])
        for name, parts in expressions.items()
    ]
    return df.agg(F.array(*cells).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing values per column as a count, a percentage and its text form."""
    counts = _per_column(
        df,
        {
            name: {"n_missing": F.count(F.when(is_missing(df, name), 1)), "n_rows": F.count("*")}
            for name in df.columns
        },
    )
    pct = F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows"))
    return counts.select("column_name", "n_missing", pct.alias("pct"), percent_text(pct).alias("pct_text"))


def missing_above(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    return missing_summary(df).where(F.col("pct") > threshold)


def _long_text(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Text columns as (column_name, value) rows."""
    cells = [F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("value")) for name in columns]
    return df.select(*ids, F.explode(F.array(*cells)).alias("_c")).select(*ids, "_c.*")


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _number_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def invalid_values(df: DataFrame, markers: Sequence[str] | None = None) -> DataFrame:
    """Text columns that hold placeholder values, with the count per column.

    The empty text always counts; a list given by the caller replaces the default markers.
    """
    return _invalid_cells(df, markers).groupBy("column_name").agg(F.count("*").alias("n_invalid"))


def invalid_examples(df: DataFrame, order_by: str, markers: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Up to `n` examples per column in the order of an id, as they stand in the table."""
    cells = _invalid_cells(df, markers, [order_by])
    return top_per_group(cells, ["column_name"], [F.col(order_by)], n, spread=True)


def _invalid_cells(df: DataFrame, markers: Sequence[str] | None, ids: Sequence[str] = ()) -> DataFrame:
    wanted = ["", *(INVALID_MARKERS if markers is None else markers)]
    return _long_text(df, _text_columns(df), ids).where(strip("value").isin(wanted))


def number_profile(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of every numeric column."""
    columns = _number_columns(df)
    cells = [F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("double").alias("value")) for name in columns]
    long = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    moments = _per_column(
        df,
        {
            name: {
                "n": F.count(f"`{name}`"),
                "mean": F.avg(F.col(f"`{name}`").cast("double")),
                "std": F.stddev_samp(F.col(f"`{name}`").cast("double")),
            }
            for name in columns
        },
    )
    spread = group_quantiles(long, ["column_name"], "value", (0.25, 0.5, 0.75)).select(
        "column_name",
        "min_value",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
        "max_value",
    )
    return moments.join(spread, "column_name", "left")


def text_profile(df: DataFrame) -> DataFrame:
    """Count, distinct values, most frequent value (ties to the smallest) and its frequency."""
    values = _long_text(df, _text_columns(df)).where("value is not null")
    counted = values.groupBy("column_name", "value").agg(F.count("*").alias("_n"))
    return counted.groupBy("column_name").agg(
        F.sum("_n").alias("n"),
        F.count("*").alias("n_distinct"),
        F.min_by("value", F.struct(-F.col("_n"), F.col("value"))).alias("top"),
        F.max("_n").alias("freq"),
    )


def column_info(df: DataFrame) -> DataFrame:
    """Type and number of values of every column."""
    return _per_column(
        df,
        {
            f.name: {"dtype": F.lit(f.dataType.simpleString()), "n_values": F.count(F.when(~is_missing(df, f.name), 1))}
            for f in df.schema.fields
        },
    )


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct values of every column, exact."""
    return _per_column(df, {name: {"n_distinct": F.count_distinct(F.col(f"`{name}`"))} for name in df.columns})


def distinct_sketches(df: DataFrame, part: Column, columns: Sequence[str], lg: int = SKETCH_LG) -> DataFrame:
    """`(part, column_name, sketch)`: a HyperLogLog sketch of each column's distinct values in each part, such as a day.

    Sketches of days are kept and merged for any span without reading its rows again. A sketch has 2**lg cells whatever it has seen;
    its estimate is off by more than three times 1.04 / sqrt(2**lg) about once in four hundred.
    """
    sketched = df.groupBy(part.alias("part")).agg(*(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg).alias(f"_s{i}") for i, c in enumerate(columns)))
    return sketched.select("part", F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)))).alias("_s")).select("part", "_s.*")


def distinct_over(sketches: DataFrame) -> DataFrame:
    """`(column_name, n_estimated)` of the merged sketches; keep the wanted parts before."""
    return sketches.groupBy("column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimated"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))
