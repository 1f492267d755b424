"""Operators against brute force: given documents, and rows with every awkward case."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import hilbert_shards, mixing, packing, parity_join, quality
from revlens.llm.tokens import byte_bpe_50k
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i * i % 997} x{i % 31}" for i in range(30_000))
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n\x0b ", None, "b"),
    (4, "one", "de", "b"),
    (4, "one", "de", "b"),
    (5, "Éa ñ 日本語  x <|endoftext|> it's  we'll　 end ", "fr", "a"),
    (None, BASE, "en", "a"),
    (7, BASE + " end", "en", "a"),
    (8, BASE.upper(), "en", "a"),
    (9, LONG, "en", "c"),
    (9, LONG + " more", "en", "c"),
    (10, "same line\nsame line\n\nsame line #### $$$", "en", None),
    (11, "x" * 70_000, "en", "a"),
]


def odd(spark, columns="doc_id long, text string, lang string, source string"):
    """The odd rows, with further columns named like results and helpers."""
    rows = spark.createDataFrame(ODD, columns)
    for clash in ("size", "n_words", "component_id", "position", "target", "rank", "length", "kept", "slot", "set_id", "_row", "key"):
        rows = rows.withColumn(clash, F.lit("clash"))
    return rows


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.fixture(params=["given", "odd"])
def case(request, spark, documents):
    """(DataFrame, its rows)"""
    if request.param == "odd":
        return odd(spark), ODD
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), documents


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def same(found, expected):
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)


def test_jaccard_components(case):
    df, rows = case
    found = parity_join.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()
    same(found, [(d, n, c) for d, n, c in brute.jaccard_components([r[:2] for r in rows])])


def edited(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"e{rng.integers(1_000_000)}"
    return " ".join(words)


def test_no_link_at_the_threshold_is_lost(spark):
    """Clusters of edits of many sizes, many pairs right at the threshold, chains included."""
    rng, rows = np.random.default_rng(7), []
    for size in (5, 6, 7, 8, 9, 10, 12, 15, 16, 20, 26, 33, 42, 60, 67, 100, 108, 173, 277, 444, 900):
        words = [f"b{size}_{i}" for i in range(size)]
        rows.append(" ".join(words))
        for _ in range(25):
            rows.append(edited(rng, words, min(size, int(rng.integers(0, max(2, size // 40 + 2))))))
        for cut in range(1, max(2, size // 5)):
            rows.append(" ".join(words[: size - cut]))
    rows = [(i, t) for i, t in enumerate(rows)]
    found = parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same(found, brute.jaccard_components(rows))


def test_buckets_in_slices(spark, monkeypatch):
    """A group of near copies whose members link in chains, with buckets cut into many slices."""
    monkeypatch.setattr(parity_join, "SLICE", 8)
    rng = np.random.default_rng(3)
    words = [f"b{i}" for i in range(150)]
    rows = [(i, edited(rng, words, int(rng.integers(1, 8)))) for i in range(200)]
    same(parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute.jaccard_components(rows))


def test_hamming_distance_bounds_the_difference():
    rng = np.random.default_rng(0)
    for size in (20, 300, 2000, 9000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[: rng.integers(size // 2, size)], rng.integers(0, 1 << 63, size // 5).astype(np.uint64)]))
            x, y = parity_join.narrow_sketch(a), parity_join.narrow_sketch(b)
            assert parity_join._differing([x], [y])[0] <= len(np.setxor1d(a, b))
            own = np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little")
            assert np.array_equal(np.unpackbits(parity_join.folded([x], 256).view(np.uint8), bitorder="little"), own.reshape(-1, 256).sum(axis=0) % 2)
    unrelated = [np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64)) for _ in range(2)]
    far = parity_join._differing(*([parity_join.narrow_sketch(s)] for s in unrelated))
    assert not parity_join._linked(np.array([1000]), np.array([1000]), far, 80)[0]


def test_quality_counts(case):
    df, rows = case
    found = quality.quality(df).select("doc_id", *quality.COUNTS[:5], "base_failed", "kept").collect()
    expected = [(r[0], *brute.quality_counts(r[1])) for r in rows]
    same([r[:6] for r in found], expected)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_more_counts(case):
    df, rows = case
    expected = []
    for r in rows:
        words = brute.words(r[1])
        expected.append((r[0], sum(any(c in "#*$%&|<>" for c in w) for w in words), sum(a == b for a, b in zip(words, words[1:], strict=False))))
    same(quality.text_features(df).select("doc_id", "n_symbol_words", "n_doubled").collect(), expected)


def test_rules_are_weighed_by_how_often_they_are_right():
    """Votes drawn from known accuracies: the estimates come near, and the posterior beats all-must-pass."""
    rng = np.random.default_rng(1)
    right, speaks, n = np.array([0.95, 0.9, 0.8, 0.6, 0.85]), np.array([0.9, 0.8, 0.9, 0.9, 0.5]), 40_000
    good = rng.random(n) < 0.8
    agree = rng.random((n, 5)) < right
    votes = np.where(rng.random((n, 5)) < speaks, np.where(agree, 1, -1) * np.where(good, 1, -1)[:, None], 0)
    patterns, weights = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_patterns(patterns, weights.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    for g, r, s in zip(model.good, right, speaks, strict=True):
        assert abs(g[2] - r * s) < 0.04
    odds = np.log(model.prior / (1 - model.prior)) + sum(
        np.log(np.array(g) / np.array(b))[votes[:, i] + 1] for i, (g, b) in enumerate(zip(model.good, model.bad, strict=True))
    )
    assert ((odds > 0) == good).mean() > ((votes >= 0).all(axis=1) == good).mean() + 0.1


def test_clean_documents_are_kept_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality.quality(docs).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r.kept for r in found if r.quality == 1 and not r.base_failed]
    assert np.mean(good) > 0.99
    assert np.mean([r.kept for r in found if r.quality == 0]) < 0.2


def test_shards(case):
    df, rows = case
    found = hilbert_shards.hilbert_shards(df, 16).collect()
    same([(r.doc_id, r["size"], r.text_crc32) for r in found], [(d, len((t or "").encode()) + 1, brute.crc32(t)) for d, t, *_ in rows])
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    counts = [len(by_shard[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and set(by_shard) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    curve = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)


def test_curve_visits_every_cell_by_single_steps(spark):
    cells = spark.range(512).select(*(((F.col("id") / 8**i).cast("long") % 8).cast("int").alias(f"x{i}") for i in range(3)))
    rows = cells.withColumn("h", hilbert_shards.hilbert_index([F.col("x0"), F.col("x1"), F.col("x2")], 3)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(512))
    assert all(sum(abs(a[i] - b[i]) for i in range(3)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_mix(case):
    df, rows = case
    found = mixing.mix(df).collect()
    size = lambda t: len(brute.words(t))
    sources = defaultdict(int)
    for r in rows:
        sources[r[3]] += size(r[1])
    goals, taken, total = brute.targets(dict(sources)), Counter(), sum(sources.values())
    same([(r.doc_id, r["size"], r.source_size) for r in found], [(r[0], size(r[1]), sources[r[3]]) for r in rows])
    for r in found:
        assert abs(r.target - goals[r.source]) < 1e-6 * max(1, goals[r.source]) and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= 6 * mixing.BLOCK
    assert sorted(found, key=str) == sorted(mixing.mix(df).collect(), key=str) and total


def test_every_stretch_of_the_mix_holds_the_shares(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string")
    goals = mixing.targets(mixing.sizes(df))
    share = {r.source: r.target for r in goals.collect()}
    rows = sorted(mixing.slots(goals).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    ranks = Counter()
    for n, r in enumerate(rows, 1):
        assert r.rank == ranks[r.source]
        ranks[r.source] += 1
        if n % 100 == 0:
            assert all(abs(ranks[s] - n * t / sum(share.values())) < 6 for s, t in share.items())


def test_ids_equal_those_of_the_vocabulary_file(case):
    import pyarrow as pa

    _, rows = case
    plain, texts = Tokenizer.from_file(JSON), [t or "" for _, t, *_ in rows]
    texts += [" " * 3000 + "x", "\n" * 5000, "a\u3000\u00a0b \u0085 c'S 'll''ve", "<|endoftext|><|endoftext|> x", "\U0001f600\u200d" * 50, "1234567 ½ ٣٤", " " * 1_500_000]
    found = list(byte_bpe_50k().encode(pa.array(texts)))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing(case):
    df, rows = case
    found = packing.pack(df, byte_bpe_50k).collect()
    plain, by_doc = Tokenizer.from_file(JSON), Counter()
    for d, t, *_ in rows:
        data = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(data) % 1024 or 1024
        for k, a in enumerate([0, *range(first, len(data), 1024)]):
            b = first if k == 0 else a + 1024
            by_doc[(d, k, a, b - a, int(__import__("zlib").crc32(data[a:b].tobytes())))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == by_doc
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * sum(n * k[3] for k, n in by_doc.items()) / 1024 + 1


def test_plan_fills_exactly_where_it_can():
    counts = np.zeros(1025, np.int64)
    for length, n in ((1024, 3), (600, 10), (424, 10), (500, 4), (300, 4), (224, 4), (400, 5), (300, 5), (200, 5), (124, 5)):
        counts[length] += n
    plan = packing.plan(counts)
    used = np.zeros(1025, np.int64)
    for combination, times in plan:
        assert sum(combination) == 1024
        for length in combination:
            used[length] += times
    assert (used == counts).all()


@pytest.mark.parametrize(
    "operator",
    [
        parity_join.jaccard_components,
        quality.quality,
        mixing.mix,
        lambda df: hilbert_shards.hilbert_shards(df, 16),
        lambda df: packing.pack(df, byte_bpe_50k),
    ],
)
def test_empty_tables_give_empty_results(spark, operator):
    assert operator(empty(spark)).count() == 0
