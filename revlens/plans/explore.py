"""The exploratory path over one raw review table: quality steps in order, then chart-ready rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from revlens.functions.text import replace_emoji
from revlens.operators.columns import (
    constant_columns,
    drop_columns,
    drop_empty_columns,
    drop_redundant_columns,
    rename_first,
    to_timestamps,
)
from revlens.operators.language import keep_language
from revlens.operators.rows import drop_duplicate_rows, drop_missing
from revlens.session import stage

# Column names of the store's export.
UNUSED = ("reviewId", "userImage", "reviewCreatedVersion", "replyContent", "repliedAt")
NAMES = {"content": "review", "score": "rating", "at": "date"}


def explore(
    raw: DataFrame,
    bank: str,
    profiles: DataFrame,
    languages: Sequence[str],
    row_id: str = "reviewId",
    source: str = "Google Store",
) -> DataFrame:
    """Drop repeats, incomplete rows and unused columns, read emoji, keep English, type and name columns.

    The distinct rows are staged, because the search for empty columns, the language test and the result each read them.
    """
    rows = stage(raw.transform(drop_duplicate_rows).transform(drop_missing, ["content", "score"]).withColumn("content", replace_emoji("content")), "distinct")
    rows = rows.transform(drop_empty_columns)
    rows = keep_language(rows, row_id, "content", profiles, languages)
    rows = rows.transform(drop_columns, [c for c in UNUSED if c in rows.columns]).transform(drop_redundant_columns)
    rows = rows.transform(to_timestamps, ["at"]).transform(rename_first, NAMES)
    return constant_columns(rows, bank=bank, source=source)
