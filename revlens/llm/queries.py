"""The registered queries of this package, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import byte_pieces, collocations, conversations, hilbert_shards, license_scan, mixing, packing, parity_join, quality, surrogates, token_trees, url_rules, vantage
from revlens.llm.common import table
from revlens.llm.tokens import byte_bpe_50k
from revlens.llm.oracles import ORACLES  # noqa: F401

SURROGATE_KEY = b"registered query"


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, folder, "documents"))
    return found.drop("matches")


def op1_license_windows(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"), windows=True).drop("matches")


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op3_edit_aware_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("edits", token_trees.cleaning_edits("text"))
    counted = token_trees.edited(token_trees.trees(docs, byte_bpe_50k, keep=("edits",)), byte_bpe_50k)
    return counted.select("doc_id", "tokens_before", "n_tokens", F.length("text").cast("long").alias("n_chars"), "reencoded", "refused", F.size("lengths").alias("n_segments"))


def op4_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vantage.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, folder, "documents"))


def op6_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, folder, "documents"), 16)


def op7_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace_pii(table(spark, folder, "documents"), SURROGATE_KEY, count="n_entities").select("doc_id", "text", "n_entities")


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), byte_bpe_50k)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents")).select("doc_id", *quality.COUNTS, "base_failed", "posterior", "kept")


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.col("source"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    return conversations.repair_report(given, conversations.damaged(given))


def op12_byte_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return byte_pieces.round_trip(table(spark, folder, "documents"), byte_pieces.multi_50k())


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op1_license_windows,
        op2_url_rules,
        op3_edit_aware_counts,
        op4_vantage_trees,
        op5_ngram_jaccard,
        op6_hilbert_shards,
        op7_pii_surrogates,
        op8_best_fit_packing,
        op9_quality_rules,
        op10_source_mix,
        op11_conversation_repair,
        op12_byte_pieces,
        op13_collocations,
    )
}

