"""TF-IDF keywords over words and word pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.functions.text import each, is_blank, joined_words, split_words, words
from revlens.session import stage

MAX_TERMS = 1_000
Split = Callable[[str], Column]


def word_pairs(df: DataFrame, keys: Sequence[str], text: str, split: Split = words) -> DataFrame:
    """One row per word with the word after it: `(keys, word, next)`, `next` NULL at the end."""
    tokens = df.select(*keys, split(text).alias("_t"))
    after = F.slice("_t", 2, F.greatest(F.size("_t"), F.lit(1)))
    zipped = each(F.arrays_zip(F.col("_t").alias("word"), after.alias("next")))
    return tokens.select(*keys, zipped.alias("_z")).where("_z is not null").select(*keys, "_z.word", "_z.next")


def _terms(docs: DataFrame, row_id: str, text: str, split: Split = words) -> DataFrame:
    """Words and pairs of neighbouring words."""
    both = F.array("word", F.concat("word", F.lit(" "), "next"))
    return word_pairs(docs, [row_id], text, split).select(row_id, F.explode(both).alias("term")).where("term is not null")


def vocabulary(df: DataFrame, row_id: str, text: str, max_terms: int = MAX_TERMS, split: Split = words, counts: DataFrame | None = None) -> DataFrame:
    """The `max_terms` most frequent terms: `(term, corpus_count)`, ties in term order.

    The words are counted first. A pair is no more frequent than either of its words, so when its
    first word is not among the `max_terms` leading words, or its second word is rarer than the last
    of them, those words all rank before the pair. Only the other pairs are counted, and the long
    tail of rare pairs is never shuffled. The words as frequent as the last leader are staged, so that
    their number, which ties can make large, is known where they meet the pairs. `counts`, `(word, corpus_count)`, are
    the words' counts, if they are known.
    """
    pairs = word_pairs(df.select(text), [], text, split)
    if counts is None:
        singles = df.select(each(split(text)).alias("word")).where("word is not null")
        counts = singles.groupBy("word").agg(F.count("*").alias("corpus_count"))
    first = [F.desc("corpus_count"), F.col("word")]
    least = counts.orderBy(*first).limit(max_terms).agg(F.min("corpus_count")).scalar()
    followers = stage(counts.where(F.col("corpus_count") >= least), "frequent-words")
    leaders = followers.orderBy(*first).limit(max_terms)
    candidates = (
        pairs.where("next is not null")
        .join(F.broadcast(leaders.select("word")), "word")
        .join(followers.select(F.col("word").alias("next")), "next", "left_semi")
    )
    paired = candidates.groupBy("word", "next").agg(F.count("*").alias("corpus_count"))
    terms = paired.select(F.concat("word", F.lit(" "), "next").alias("term"), "corpus_count")
    terms = terms.unionByName(leaders.withColumnRenamed("word", "term"))
    return terms.orderBy(F.desc("corpus_count"), "term").limit(max_terms)


def term_weights(df: DataFrame, row_id: str, text: str, max_terms: int = MAX_TERMS, joined: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """Per review and vocabulary term: `tf`, `df` and the weight normalised to unit length.

    The text itself is never shuffled: its words are written once, one pass counts the vocabulary, a second one counts
    only the vocabulary's terms per review, combined before they move. Those counts are staged, because both the document
    frequencies and the weights read them. With `joined`, `text` holds `joined_words` of texts that are not blank and
    is read as it is; `counts`, `(word, corpus_count)`, are their words' counts, if they are known.
    """
    docs = df.select(row_id, F.col(text).alias("_text"))
    if not joined:
        docs = stage(docs.where(~is_blank("_text")).withColumn("_text", joined_words("_text")), "words")
    # The vocabulary holds at most `max_terms` rows by construction.
    terms = F.broadcast(vocabulary(docs, row_id, "_text", max_terms, split_words, counts).select("term"))
    found = _terms(docs, row_id, "_text", split_words).join(terms, "term")
    tf = stage(found.groupBy(row_id, "term").agg(F.count("*").alias("tf")), "term-counts")
    df_counts = tf.groupBy("term").agg(F.count("*").alias("df"))
    n_docs = docs.agg(F.count("*").alias("n")).scalar()
    idf = df_counts.select("term", "df", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("_idf"))
    raw = tf.join(F.broadcast(idf), "term").withColumn("_w", F.col("tf") * F.col("_idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(row_id)))
    return raw.select(row_id, "term", "tf", "df", (F.col("_w") / norm).alias("weight"))


def ranked_keywords(
    df: DataFrame, row_id: str, text: str, top_k: int = 5, max_terms: int = MAX_TERMS, joined: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """The `top_k` heaviest terms of each review with their rank; ties in term order."""
    order = Window.partitionBy(row_id).orderBy(F.desc(F.round("weight", 12)), "term")
    ranked = term_weights(df, row_id, text, max_terms, joined, counts).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top_k)


def keyword_lists(
    df: DataFrame,
    row_id: str,
    text: str,
    top_k: int = 5,
    max_terms: int = MAX_TERMS,
    out: str = "keywords",
    joined: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """`(row_id, keywords)`, best keyword first, for the reviews that have any."""
    best = ranked_keywords(df, row_id, text, top_k, max_terms, joined, counts)
    lists = best.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_k"))
    return lists.select(row_id, F.col("_k.term").alias(out))


def attach_keywords(df: DataFrame, lists: DataFrame, row_id: str, out: str = "keywords") -> DataFrame:
    """Join the lists back; reviews without any keyword get an empty list."""
    return df.join(lists, row_id, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def add_keywords(df: DataFrame, row_id: str, text: str, top_k: int = 5, max_terms: int = MAX_TERMS) -> DataFrame:
    return attach_keywords(df, keyword_lists(df, row_id, text, top_k, max_terms), row_id)
