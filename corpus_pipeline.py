"""A corpus pipeline: quality, near-duplicates, personal data, mix, packing. Each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlens.llm import mixing, packing, parity_join, quality, surrogates
from revlens.llm.common import staged, table
from revlens.llm.tokens import byte_bpe_50k

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
KEY = b"corpus pipeline"
# Near copies: runs of five words with a Jaccard of 0.8. The other values of op5 are that query's own.
NEAR_WIDTH, NEAR_THRESHOLD = 5, 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep; rejected ones go."""
    return quality.kept_documents(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that links connect."""
    return parity_join.one_per_class(docs, width=NEAR_WIDTH, threshold=NEAR_THRESHOLD)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by surrogates."""
    return surrogates.replace_pii(docs, KEY)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two times."""
    return mixing.repeated(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences."""
    return packing.pack(docs, byte_bpe_50k)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("mix", mixed_sources),
    ("packing", packed),
]

#: The stages fit models, draw keyed surrogates and tokenise, which SQL does not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is written to the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, name)
    return docs
