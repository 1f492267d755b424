"""Streaming forms of ingest, de-duplication, trends, load and scoring.

Each job takes a streaming DataFrame and finishes what is available, or keeps running with another
trigger. Checkpoints belong in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from revlens.operators.lexicon import compound
from revlens.operators.sentiment import add_sentiment
from revlens.operators.themes import themes_of_text
from revlens.sources import ledger
from revlens.sources.warehouse import append_facts

ALL_AVAILABLE = {"availableNow": True}


def read_landing(spark: SparkSession, folder: str, schema: T.StructType, files: str | None = None, per_batch: int = 1_000) -> DataFrame:
    """Landed Parquet pages as a stream; `files` picks names by glob."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.parquet(folder)


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the stream to a Parquet folder, each input row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start(path)


def first_arrivals(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """The first arrived row of each key; keys are remembered for `delay` beyond the newest event.

    The batch form keeps the newest row instead: a stream cannot take back what it has emitted.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def weekly_counts(stream: DataFrame, event_time: str, label: str, delay: str = "7 days") -> DataFrame:
    """Rows per week, Monday to Sunday in UTC, and label; the week is named by its Sunday."""
    week = F.window(F.col(event_time), "7 days", startTime="4 days")
    counts = stream.withWatermark(event_time, delay).groupBy(week.alias("_week"), label).agg(F.count("*").alias("count"))
    end = F.to_utc_timestamp("_week.end", F.current_timezone())
    return counts.select(F.date_sub(F.to_date(end), 1).alias("week_ending"), label, "count")


def weekly_sentiment(stream: DataFrame, event_time: str = "review_ts", delay: str = "7 days") -> DataFrame:
    return weekly_counts(stream.where(F.col("sentiment_label").isNotNull()), event_time, "sentiment_label", delay)


def replace_table(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep an aggregate up to date: each batch writes the complete result as a new version and then records it.

    Readers follow the record (`read_table`), so that a version is never overwritten while it is read and a broken one is never
    seen. Old versions stay until the caller removes them.
    """

    def write(batch: DataFrame, _: int) -> None:
        name = uuid.uuid4().hex
        batch.write.parquet(f"{path}/version={name}")
        ledger.record(batch.sparkSession, path, name)

    return for_each_batch(stream, write, checkpoint, trigger, "complete")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest recorded version of a table that `replace_table` keeps."""
    name = ledger.newest(spark, path)
    if name is None:
        raise ValueError(f"no version of {path} is recorded")
    return spark.read.parquet(f"{path}/version={name}")


def for_each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(work)
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start()


def load_facts(stream: DataFrame, to_facts: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Load each batch into the fact table; a batch that runs again, from the same checkpoint or another, adds nothing."""

    def load(batch: DataFrame, _: int) -> None:
        append_facts(to_facts(batch), path)

    return for_each_batch(stream, load, checkpoint, trigger)


def append_batches(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a batch transformation of each batch; a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return for_each_batch(stream, write, checkpoint, trigger)


def score_with_model(
    stream: DataFrame, model: DataFrame, row_id: str, text: str, path: str, checkpoint: str, trigger: dict | None = None, keep: Sequence[str] | None = None
) -> StreamingQuery:
    """Sentiment of each review from a word model that was trained before the stream started; of the stream's columns `keep` alone, or all."""

    def score(batch: DataFrame) -> DataFrame:
        scored = add_sentiment(batch, row_id, text, model)
        return scored if keep is None else scored.select(*keep, "sentiment_label", "sentiment_score")

    return append_batches(stream, score, path, checkpoint, trigger)


def score_rows(stream: DataFrame, text: str) -> DataFrame:
    """Lexicon score and themes of each row as it passes: no state, no shuffle."""
    return stream.withColumns({"compound": compound(text), "themes": themes_of_text(text)})
