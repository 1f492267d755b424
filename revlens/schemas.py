"""Schemas of the tables that cross a process boundary."""

from __future__ import annotations

from pyspark.sql import types as T

_KEYWORDS = T.ArrayType(T.StringType())


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


RAW_REVIEWS = _schema(
    review_id=T.LongType(),
    bank=T.StringType(),
    content=T.StringType(),
    score=T.IntegerType(),
    review_ts=T.TimestampNTZType(),
    thumbs_up=T.IntegerType(),
)

CLEAN_REVIEWS = _schema(
    review_id=T.LongType(),
    review=T.StringType(),
    rating=T.IntegerType(),
    date=T.StringType(),
    bank=T.StringType(),
    source=T.StringType(),
)

SCORED_REVIEWS = T.StructType(
    CLEAN_REVIEWS.fields
    + _schema(
        cleaned_text=T.StringType(),
        sentiment_label=T.StringType(),
        sentiment_score=T.DoubleType(),
        keywords=_KEYWORDS,
        themes=_KEYWORDS,
    ).fields
)

BANKS = _schema(id=T.LongType(), name=T.StringType(), created_at=T.TimestampType())

REVIEW_FACTS = _schema(
    id=T.StringType(),
    bank_id=T.LongType(),
    review_text=T.StringType(),
    rating=T.DecimalType(2, 1),
    review_date=T.DateType(),
    source=T.StringType(),
    cleaned_text=T.StringType(),
    sentiment_label=T.StringType(),
    sentiment_score=T.DoubleType(),
    keywords=T.StringType(),
    themes=T.StringType(),
    created_at=T.TimestampType(),
)

EVENTS = _schema(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

DOCUMENTS = _schema(
    doc_id=T.LongType(),
    text=T.StringType(),
    lang=T.StringType(),
    source=T.StringType(),
    n_chars=T.LongType(),
)
