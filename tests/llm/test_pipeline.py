"""The corpus pipeline, stage by stage against brute force, and on awkward rows."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import mixing, parity_join, quality, surrogates
from tests.llm import brute
from tests.llm.test_operators import FOLDER, ODD, empty, odd


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_every_stage_on_the_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "packing"]
    stages, before = dict(corpus_pipeline.STAGES), docs
    for name in ("quality", "near_duplicates", "personal_data", "mix"):
        after = corpus_pipeline.staged(stages[name](spark, before, FOLDER), "test_stage")
        assert after.columns == docs.columns
        had, has = rows_of(before), rows_of(after)
        if name == "quality":
            kept = {r.doc_id for r in quality.quality(before).where("kept").collect()}
            assert Counter(has) == Counter(r for r in had if r[0] in kept) and 0 < len(has) < len(had)
        elif name == "near_duplicates":
            firsts = {c for _, n, c in brute.jaccard_components([r[:2] for r in had], 5, 80)}
            assert Counter(has) == Counter(r for r in had if r[0] in firsts) and len(has) < len(had)
        elif name == "personal_data":
            old = {r[0]: r for r in had}
            assert len(old) == len(has) and all(r[2:] == old[r[0]][2:] for r in has)
            for r in has:
                entities = [(k, old[r[0]][1][a:b]) for k, a, b in surrogates.find(old[r[0]][1])]
                assert (r[1] == old[r[0]][1]) == (not entities)
                assert all(value not in r[1] for kind, value in entities)
        else:
            times = Counter(r[0] for r in has)
            for r in mixing.mix(before).collect():
                assert times[r.doc_id] == int(r.taken / max(r["size"], 1) + 0.5) <= 2
        before = after
    packed = corpus_pipeline.STAGES[4][1](spark, before, FOLDER).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in has)
    filled = defaultdict(int)
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[c] for c in columns) for r in whole) == Counter(tuple(r[c] for c in columns) for r in packed)


def test_awkward_rows_pass_every_stage(spark):
    for df in (odd(spark), empty(spark)):
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = corpus_pipeline.staged(stage(spark, df, FOLDER), name)
            assert df.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, df, FOLDER).collect()


def test_one_document_of_each_class_stays(spark):
    rows = [*ODD, (1, ODD[6][1], "xx", "z"), (None, ODD[6][1], "yy", None), (8, ODD[6][1], "zz", "q"), (20, "alone " * 9, "en", "a"), (20, "other " * 9 + "word", "en", "a")]
    found = rows_of(parity_join.one_per_class(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    sets = [brute.shingles(r[1]) for r in found]
    worded = [s for s in sets if s]
    assert len(worded) == len(set(worded)) and len(sets) - len(worded) == sum(not brute.shingles(r[1]) for r in rows)
    assert not set(found) - set(rows)
    kept = {r[0] for r in found if brute.shingles(r[1])}
    assert 1 in kept and 20 in kept and 7 not in kept and len([r for r in found if r[0] == 20]) == 2


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    words = [f"w{i}" for i in range(1000)]
    longer = [*words, *(f"x{i}" for i in range(200))]
    scattered = [f"y{i}" if i % 47 == 20 else w for i, w in enumerate(words)]
    apart = [f"z{i}" if i % 40 == 20 else w for i, w in enumerate(words)]
    other = [f"v{i}" for i in range(500)]
    rows = [(21, words), (22, longer), (23, scattered), (24, words[:830]), (25, apart), (26, other), (27, other[:390])]
    rows = [(i, " ".join(t), "en", "a") for i, t in rows]
    sets = {i: brute.shingles(t, 5) for i, t, *_ in rows}
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(0.8 <= share(21, i) < 0.85 for i in (22, 23, 24)) and all(share(i, 25) < 0.8 for i in sets if i != 25) and share(26, 27) < 0.8
    docs = spark.createDataFrame([*rows, *((i + 50, *r[1:]) for i, r in enumerate(rows)), *ODD[:4]], "doc_id long, text string, lang string, source string")
    had = rows_of(docs)
    firsts = {c for _, _, c in brute.jaccard_components([r[:2] for r in had], width=5, threshold=80)}
    kept = rows_of(dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, FOLDER))
    assert {r[0] for r in kept if r[1] and r[1].split()} == {r[0] for r in had if r[0] in firsts and r[1] and r[1].split()}
    assert {21, 25, 26, 27} <= {r[0] for r in kept} and not {22, 23, 24, 71} & {r[0] for r in kept}


def test_clashing_columns(spark):
    """Columns that are called like the stages' own helpers stay as they are."""
    rows = odd(spark)
    for clash in ("_held", "held", "_id", "id", "_copies", "copies", "_copy", "doc", "col", "component", "source_size", "taken"):
        rows = rows.withColumn(clash, F.lit("clash"))
    kept = parity_join.one_per_class(rows)
    assert kept.columns == rows.columns and 0 < kept.count() < len(ODD)
    mixed = mixing.repeated(rows, mixing.mix(rows))
    assert mixed.columns == rows.columns and {r["_copy"] for r in mixed.collect()} == {"clash"}


def test_planted_copies_of_the_near_duplicate_stage(spark):
    """Runs of five words at 0.8: copies with a fifth more words link, those with a third more do not; long texts that share half don't."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(1000)]
    rows = [(1, base), (2, base + [word() for _ in range(200)]), (3, base + [word() for _ in range(330)])]
    shared = [word() for _ in range(1500)]
    rows += [(10 + i, shared + [word() for _ in range(1000 + 300 * i)]) for i in range(8)]
    hub = [word() for _ in range(700)]
    rows.append((60, hub))
    for i in range(20):  # edited copies that link with what they were copied from, but not with each other
        copy = list(hub)
        for at in draw.sample(range(0, 700, 6), 15):
            copy[at] = word()
        rows.append((100 + i, copy))
    rows = [(i, " ".join(words), "en", "a") for i, words in rows]
    found = parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), width=5, threshold=80)
    assert sorted(map(tuple, found.collect())) == sorted(brute.jaccard_components([r[:2] for r in rows], 5, 80))
