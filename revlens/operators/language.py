"""Language of a text from the letter groups of its words (naive Bayes over trigrams)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.functions.text import _col, each
from revlens.operators.joins import spread_join
from revlens.operators.sentiment import each_or_none
from revlens.session import fresh_path

WORD = r"\p{L}+"


NON_LETTERS = r"\P{L}+"
EVERY_THREE = r"(?=(.{3}))"


def _grams(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Every three neighbouring characters of the words, each word between single blanks.

    Words stand two blanks apart, so a triple that would join two words holds a double blank and
    equals no profiled trigram.
    """
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(_col(text)), NON_LETTERS, "  "), F.lit(" "))
    triples = F.regexp_extract_all(spaced, F.lit(EVERY_THREE), F.lit(1))
    return df.select(*keys, each(triples).alias("gram")).where("gram is not null")


def train_profiles(df: DataFrame, text: str, lang: str, languages: Sequence[str]) -> DataFrame:
    """How often each language has each trigram: `(lang, gram, n)`."""
    known = df.where(F.col(lang).isin(list(languages))).select(F.col(lang).alias("lang"), text)
    tokens = known.select("lang", each(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("word"))
    # Words repeat far more than texts do: count them first, cut the distinct ones into trigrams.
    words = tokens.where("word is not null").groupBy("lang", "word").agg(F.count("*").alias("_n"))
    grams = _grams(words, ["lang", "_n"], "word").where(~F.col("gram").contains("  "))
    return grams.groupBy("lang", "gram").agg(F.sum("_n").alias("n"))


def detect_language(df: DataFrame, row_id: str, text: str, profiles: DataFrame, languages: Sequence[str]) -> DataFrame:
    """`(row_id, detected_lang, lang_score)`: the language with the best mean log probability, smoothed by the number
    of distinct trigrams.

    Texts without any known trigram are not in the result. Profiles that were staged or read have a known size, and
    Spark broadcasts the model when it is small; beyond that, frequent trigrams are spread over slices.
    """
    languages = sorted(languages)
    of = [F.col("lang") == name for name in languages]
    totals = profiles.agg(F.array(*[F.sum(F.when(is_lang, F.col("n"))) for is_lang in of], F.count_distinct("gram"))).scalar()
    model = profiles.groupBy("gram").agg(
        *[
            F.log((F.coalesce(F.max(F.when(is_lang, F.col("n"))), F.lit(0)) + 1) / (F.coalesce(totals[i], F.lit(0)) + totals[len(languages)])).alias(f"_p{i}")
            for i, is_lang in enumerate(of)
        ]
    )
    sums = (
        spread_join(_grams(df, [row_id], text), model, ["gram"], spread_on=row_id)
        .groupBy(row_id)
        .agg(F.count("*").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(len(languages))])
    )
    ranked = F.array_max(
        F.array(
            *[
                F.struct((F.col(f"_p{i}") / F.col("_n")).alias("score"), F.lit(-i).alias("i"), F.lit(name).alias("lang"))
                for i, name in enumerate(languages)
            ]
        )
    )
    best = sums.select(row_id, ranked.alias("_b"))
    return best.select(row_id, F.col("_b.lang").alias("detected_lang"), F.col("_b.score").alias("lang_score"))


def add_language(df: DataFrame, row_id: str, text: str, profiles: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Attach the detected language; NULL where none can be told."""
    return df.join(detect_language(df, row_id, text, profiles, languages), row_id, "left")


def keep_language(
    df: DataFrame, row_id: str, text: str, profiles: DataFrame, languages: Sequence[str], wanted: str = "en"
) -> DataFrame:
    """Rows whose text is in the wanted language; undetectable texts are dropped."""
    found = detect_language(df, row_id, text, profiles, languages)
    return df.join(found.where(F.col("detected_lang") == wanted).select(row_id), row_id, "left_semi")


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("_hash", F.xxhash64("_text"))


def translate(
    df: DataFrame,
    row_id: str,
    text: str,
    lang: str,
    memory: DataFrame,
    translate_batch: Callable[[pd.DataFrame], pd.Series] | None = None,
    into: str = "en",
) -> DataFrame:
    """Replace foreign text by its translation; what cannot be translated stays as it is.

    `memory(lang, text, translation)` holds known translations; of several for one text the smallest counts. With
    `translate_batch`, each distinct text the memory lacks is sent once, in batches of
    `(lang, text)`; it returns one translation, or None, per row. A batch that fails is tried again row by row,
    and a row that fails keeps its text.
    """
    # Rows that need no translation get a key of their own and no text: they match nothing and
    # spread over all tasks.
    foreign = F.coalesce(F.col(lang) != into, F.lit(False))
    own_key = F.concat(F.lit("row:"), F.col(row_id).cast("string"))
    keyed = df.withColumns(
        {"_lang": F.when(foreign, F.col(lang)).otherwise(own_key), "_text": F.when(foreign, F.col(text))}
    )
    known = memory.groupBy(F.col("lang").alias("_lang"), F.col("text").alias("_text")).agg(F.min("translation").alias("_t"))
    keys = ["_lang", "_hash", "_text"]
    if translate_batch is not None:
        wanted = keyed.where("_text is not null").select("_lang", "_text").distinct()
        misses = wanted.join(known, ["_lang", "_text"], "left_anti")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                given = batch.rename(columns={"_lang": "lang", "_text": "text"})
                yield batch.assign(_t=each_or_none(lambda rows: list(translate_batch(given.iloc[rows])), list(range(len(given)))))

        # Written once, so that neither a second reader nor a lost executor repeats the calls.
        path = fresh_path(df.sparkSession, "translations")
        misses.mapInPandas(run, "_lang string, _text string, _t string").write.parquet(path)
        known = known.unionByName(df.sparkSession.read.parquet(path))
    # The hash settles most comparisons of the sort before the texts are looked at; a text that is
    # much of the table makes a skewed partition, which the adaptive join splits.
    found = _hashed(keyed).join(_hashed(known), keys, "left")
    return found.withColumn(text, F.coalesce("_t", text)).select(*df.columns)
