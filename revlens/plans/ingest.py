"""All banks from landed pages to the cleaned, partitioned table in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from revlens import schemas
from revlens.sources.files import write_parquet, write_per_bank
from revlens.sources.landing import MIN_REVIEWS, clean_reviews, newest_reviews, volume_check


@dataclass(frozen=True)
class Ingested:
    raw: DataFrame
    cleaned: DataFrame
    volumes: DataFrame


def ingest(raw: DataFrame, banks: DataFrame, max_reviews: int | None = None, min_reviews: int = MIN_REVIEWS, source: str = "Google Play") -> Ingested:
    """All reviews, or the newest of each bank, cleaned, with the volume check of every expected bank."""
    newest = newest_reviews(raw, max_reviews)
    cleaned = clean_reviews(newest, source)
    return Ingested(newest, cleaned, volume_check(cleaned, banks, min_reviews))


def ingest_folder(spark: SparkSession, landing: str, banks: DataFrame, out: str, **options) -> Ingested:
    """Read landed pages, write `raw`, `by_bank`; later readers use the written tables."""
    raw = spark.read.schema(schemas.RAW_REVIEWS).parquet(landing)
    staged = ingest(raw, banks, **options)
    write_parquet(staged.raw, f"{out}/raw")
    written_raw = spark.read.parquet(f"{out}/raw")
    write_per_bank(clean_reviews(written_raw, options.get("source", "Google Play")), f"{out}/by_bank")
    cleaned = spark.read.parquet(f"{out}/by_bank")
    return Ingested(written_raw, cleaned, volume_check(cleaned, banks, options.get("min_reviews", MIN_REVIEWS)))
