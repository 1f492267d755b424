"""Reading and writing review files through Spark's own readers and writers."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from revlens.functions.lists import list_to_json, parse_list
from revlens.session import stage

log = logging.getLogger(__name__)

# Review text holds line breaks and quotes.
_LAYOUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
CSV_OPTIONS = {**_LAYOUT, "multiLine": True}
FORMATS = ("csv", "parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the cost of one more read."""
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType | str, **options: object) -> tuple[DataFrame, DataFrame]:
    """CSV of a known schema as (rows, rejects(record)): records that do not fit it, as they stand in the file.

    A record is rejected if a field does not parse as its type or there are too few or too many fields. The files
    are parsed once, into a staged table; both results read that.
    """
    known = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = "_record"
    while raw in known.fieldNames():
        raw = "_" + raw
    read = read_csv(spark, path, T.StructType([*known.fields, T.StructField(raw, T.StringType())]), mode="PERMISSIVE", columnNameOfCorruptRecord=raw, **options)
    parsed = stage(read, "parsed-csv")
    return parsed.where(F.col(raw).isNull()).drop(raw), parsed.where(F.col(raw).isNotNull()).select(F.col(raw).alias("record"))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def load(
    spark: SparkSession,
    source: str,
    file_type: str = "csv",
    base_path: str | None = None,
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """Load a file or folder by format; `base_path` is put in front of a relative name."""
    if file_type not in FORMATS:
        raise ValueError(f"unsupported file type {file_type!r}, expected one of {FORMATS}")
    absolute = source.startswith("/") or "://" in source
    path = source if base_path is None or absolute else f"{base_path.rstrip('/')}/{source}"
    read = read_csv if file_type == "csv" else read_parquet
    try:
        df = read(spark, path, schema, **options)
    except Exception:
        log.exception("could not load %s as %s", path, file_type)
        raise
    log.info("loaded %s as %s with columns %s", path, file_type, df.columns)
    return df


def lists_as_text(df: DataFrame) -> DataFrame:
    """List columns as JSON text, the form in which CSV can hold them."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({name: list_to_json(name) for name in lists})


def text_as_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: parse_list(name) for name in columns})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV files with headers. Quoting covers line breaks; lists become JSON text."""
    out = lists_as_text(df).write.mode(mode).options(**_LAYOUT)
    # Blanks around a text are part of it. CSV has no NULL: an empty text reads back as missing.
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_per_bank(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per bank, so that a reader of one bank opens only its files.

    Rows are gathered by bank first, or every task would leave a file in every folder. The
    rebalancing splits a bank with much of the data over many tasks.
    """
    write_parquet(df.hint("rebalance", "bank"), path, mode, ["bank"])


def report_export(df: DataFrame) -> DataFrame:
    """The six columns of the exported report."""
    return df.select("review_text", "bank", "rating", "sentiment_label", "sentiment_score", F.col("themes"))
