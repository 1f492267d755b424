"""Normalised review text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.text import SPACES, _col, each, normalise, strip_punctuation
from revlens.functions.vocab import LEMMAS, STOP_WORDS
from revlens.operators.joins import spread_join


def add_cleaned_text(
    df: DataFrame,
    text: str,
    out: str = "cleaned_text",
    stop_words: Sequence[str] = STOP_WORDS,
    lemmas: Mapping[str, str] = LEMMAS,
) -> DataFrame:
    """Normalise with dictionaries small enough to travel inside the plan."""
    return df.withColumn(out, normalise(text, stop_words, lemmas))


def add_cleaned_text_from_tables(
    df: DataFrame, row_id: str, text: str, stop_words: DataFrame, lemmas: DataFrame, out: str = "cleaned_text"
) -> DataFrame:
    """Normalise with dictionaries given as tables: `stop_words(word)`, `lemmas(word, base)`.

    For dictionaries too large for a plan. A review's distinct words meet the dictionaries and those that stand there return
    to it; the other words stay in the text, which moves once to its id. Prefer `add_cleaned_text` where the dictionaries are small.
    """
    words = df.select(row_id, each(F.array_distinct(_parts(text))).alias("word")).where("word != ''")
    stops = stop_words.select("word").distinct()
    bases = lemmas.groupBy("word").agg(F.array_sort(F.collect_list(F.coalesce("base", "word"))).alias("bases")).join(stops, "word", "left_anti")
    entries = bases.unionByName(stops.withColumn("bases", F.array().cast("array<string>")))
    found = spread_join(words, entries, ["word"], spread_on=row_id).groupBy(row_id).agg(F.map_from_entries(F.collect_set(F.struct("word", "bases"))).alias("_found"))
    # Rows that share an id share their words, place by place.
    texts = df.groupBy(row_id).agg(F.collect_list(text).alias("_texts")).join(found, row_id, "left")

    def based(word: Column) -> Column:
        return F.when(word == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.element_at("_found", word), F.array(word)))

    def placed(word: Column, place: Column) -> Column:
        return F.transform(based(word), lambda base: F.struct(place.alias("place"), base.alias("base")))

    alone = F.flatten(F.transform(_parts(F.get("_texts", F.lit(0))), based))
    shared = F.array_sort(F.flatten(F.flatten(F.transform("_texts", lambda one: F.transform(_parts(one), placed)))))["base"]
    cleaned = texts.select(row_id, F.array_join(F.when(F.size("_texts") > 1, shared).otherwise(alone), " ").alias(out))
    return df.join(cleaned, row_id, "left").withColumn(out, F.coalesce(out, F.lit("")))


def _parts(text: Column | str) -> Column:
    """The words of a text in order, with empty ones where it begins or ends with white space."""
    return F.split(strip_punctuation(F.lower(F.coalesce(_col(text), F.lit("")))), SPACES)
