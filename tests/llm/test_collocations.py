"""Phrases against counting every run of words."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from revlens.llm import collocations
from tests.llm import brute
from tests.llm.test_operators import FOLDER, ODD, empty, odd


def found(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


def test_given_documents(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in df.select("text", "lang").collect()]
    assert found(df) == sorted(brute.collocations(rows))
    assert found(df, least=7, longest=3, top=40) == sorted(brute.collocations(rows, 7, 3, 40))


def test_odd_and_empty_tables(spark):
    df = odd(spark)
    for clash in ("a", "n", "id", "chunk", "at", "phrase", "heads", "_less", "left"):
        df = df.withColumn(clash, F.lit("clash"))
    assert found(df, least=2) == sorted(brute.collocations([(r[1], r[2]) for r in ODD], least=2))
    assert found(empty(spark)) == [] and found(odd(spark).where("doc_id = 4"), least=5) == []


def test_repeats_ties_and_borders(spark):
    draw = random.Random(2)
    words = ["New", "YORK", "stock", "exchange", "a", "a", "a", "é", "\x00x", "co\x1c"]
    rows = [("".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ". ", ",", "\r\n", " ! "]) for _ in range(400)), draw.choice(["en", None, "und", ""])) for _ in range(40)]
    rows += [("new york stock exchange opens", "en")] * 30
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    assert found(df, least=9) == sorted(brute.collocations(rows, least=9))
    assert found(df, least=9, top=5) == sorted(brute.collocations(rows, least=9, top=5))


def test_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 2000)
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in df.select("text", "lang").collect()]
    assert found(df, least=50) == sorted(brute.collocations(rows, 50))


def test_tiles_count_like_sorting():
    """Dense tiles, sparse ones and both at once; ids over many tiles."""
    draw = np.random.default_rng(4)
    for spread in (3, 30, 3000):
        stream = np.minimum(draw.geometric(1 / spread, 20_000), 1 << 20).astype(np.uint32)
        stream[draw.integers(0, len(stream), 500)] = collocations.NONE
        pairs = collocations.stream_pairs(stream)[1]
        for tile in (4, 64, 1024):
            keys, counts = collocations.tile_counts(pairs, tile)
            expected = np.unique(pairs, return_counts=True)
            order = np.argsort(keys)
            assert np.array_equal(keys[order], expected[0]) and np.array_equal(counts[order], expected[1])


def test_scores_beyond_64_bits(spark):
    """a * n * 1000 and l * r pass 64 bits; the quotient is exact."""
    a, n, left, right = 3_000_000_007, 8_000_000_000_123, 5_000_000_011, 4_000_000_007
    df = spark.createDataFrame([(a, n, [left, a], [right, a])], "a long, n long, heads array<long>, tails array<long>")
    assert df.select(collocations._cuts(2).alias("cut")).first().cut.score == 1000 * a * n // (left * right)


def test_names_of_many_chunks_meet_in_few_rows(spark):
    """As many chunks as words: what is looked up is a row for each chunk and share, not for each chunk and word, with the ids of a plain join."""
    words = [f"w{i}" for i in range(500)] + ["\x00x", "é", " "]
    asked = [(c, lang, ["\n", *words[c % 7 :: 1 + c % 3], f"rare{c}"]) for c, lang in enumerate(["en", "und", "", "de"] * 6)]
    known = [(lang, w, 1000 * k + i) for k, lang in enumerate(["en", "und", "fr", ""]) for i, w in enumerate(words[:: k + 1])]
    asking, numbers = spark.createDataFrame(asked, "chunk long, lang string, names array<string>"), spark.createDataFrame(known, "lang string, name string, id long")
    parts = collocations.shares(asking)
    rows = collocations.looked_up(asking, numbers, parts).collect()
    got = sorted((r.chunk, int(at), int(i)) for r in rows for at, i in zip(*collocations.opened(pa.scalar(bytes(r.names))).reshape(2, -1), strict=True))
    ids = {(lang, w): i for lang, w, i in known}
    assert got == sorted((c, at, ids[lang, w]) for c, lang, names in asked for at, w in enumerate(names) if (lang, w) in ids)
    assert 3 * len(rows) < len(got) and len(rows) <= len(asked) * parts < 200 * len(asked)
    pairs = spark.createDataFrame([(0, "", [5, 1 << 63 - 1, 7])], "chunk long, lang string, names array<long>")
    (row,) = collocations.looked_up(pairs, spark.createDataFrame([("", 7, 9)], "lang string, name long, id long"), parts, first=1, sure=True).collect()
    assert collocations.opened(pa.scalar(bytes(row.names))).tolist() == [3, 9]


def test_pairs_of_chunks_move_in_few_bytes(spark, monkeypatch):
    """Counts of all chunks, added a few at a time; what moves is a row for each chunk and share."""
    monkeypatch.setattr(collocations, "ADDED", 1000)
    draw = np.random.default_rng(5)
    streams = [np.minimum(draw.geometric(1 / 300, 5000), 1 << 20).astype(np.uint32) for _ in range(12)]
    streams[3][::7] = collocations.NONE
    streams += [np.zeros(0, np.uint32), np.array([3_000_000_000, 4_294_967_294] * 9, np.uint32)]
    df = spark.createDataFrame([(collocations.shut(s),) for s in streams], "stream binary")
    keys, counts = np.unique(np.concatenate([collocations.stream_pairs(s)[1] for s in streams]), return_counts=True)
    for least in (1, 5):
        got = sorted(map(tuple, collocations.pair_counts(df, least, collocations.shares(df)).collect()))
        assert got == sorted(zip(keys[counts >= least].view(np.int64).tolist(), counts[counts >= least].tolist(), strict=True))
    plan = collocations.pair_counts(df, 5, 8)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(share" in plan and "hashpartitioning(key" not in plan
