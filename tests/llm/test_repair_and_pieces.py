"""Conversation repair and byte-level pieces against brute force and the libraries they stand beside."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from revlens.llm import byte_pieces, conversations
from tests.llm import brute
from tests.llm.test_operators import FOLDER, ODD, empty, odd

ROWS = "conv_id long, turn long, role string, text string"
REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ROLES = ["user", "assistant", "user", "assistant", "system", "tool", ""]
TEXTS = ["a.", "b", "c!", " ", "hello there?\n", "x\x0by"]


def some_conversations(seed):
    draw = random.Random(seed)
    return [(c, t + 20 * (draw.random() < 0.1), draw.choice(ROLES), draw.choice(TEXTS)) for c in range(150) for t in range(draw.randint(1, 12))]


def report(df):
    return sorted((tuple(r) for r in conversations.repair_report(df, conversations.damaged(df)).select(*REPORT).collect()), key=repr)


def expected(rows):
    return sorted(brute.conversation_report(rows), key=repr)


def test_repair_of_given_conversations(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert report(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_repair_of_odd_conversations(spark):
    rows = some_conversations(5)
    rows += [(None, None, None, None), (None, 1, "user", "x."), (900, None, "user", None), (901, None, "assistant", "late."), (901, None, "user", "first."), (902, 1, "user", "u" * 100_000 + ".")]
    rows += [(903, 4, "user", "again and again.")] * 300 + [(904, 0, "user", "")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    for clash in ("cost", "audit", "place", "_d", "_n", "part", "gaps", "_kind"):
        df = df.withColumn(clash, F.lit("clash"))
    assert report(df) == expected(rows)
    assert report(spark.createDataFrame([], ROWS)) == []


def test_a_conversation_over_many_tasks(spark):
    """One conversation of most rows is cut by partitions and stretches; what repeats in it is far apart."""
    draw = random.Random(3)
    rows = [(7, t, draw.choice(ROLES), f"text {draw.randint(0, 1500)}{draw.choice(['.', ''])}") for t in range(1800)] + some_conversations(9)[:60]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = report(spark.createDataFrame(rows, ROWS))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == expected(rows)


def test_search_meets_every_tie():
    """Both directions together find what trying everything finds, from each state to each state."""
    draw = random.Random(11)
    for _ in range(300):
        rows = tuple(draw.choice([("u", 0), ("a", 0), ("s", 0), ("x", 1), ("u", 1), ("a", 1), draw.randint(1, 3)]) for _ in range(draw.randint(1, 9)))
        for leave in ((0, 3), (1,), (2,)):
            costs = {}
            frontier = {(0, 0): [(0, "")]}
            for at in range(len(rows) + 1):  # all audits, inserts first, kept to the least of each cost
                for _ in range(5):
                    for state in range(4):
                        for cost, audit in list(frontier.get((at, state), [])):
                            to = frontier.setdefault((at, conversations.NEXT[state]), [])
                            if (cost + 2, audit + "I") not in to and cost < 30:
                                to.append((cost + 2, audit + "I"))
                    for key in list(frontier):
                        frontier[key] = sorted(set(frontier[key]))[:40]
                if at < len(rows):
                    for state in range(4):
                        for cost, audit in frontier.get((at, state), []):
                            for after, more, edit in conversations._steps(rows[at], state):
                                frontier.setdefault((at + 1, after), []).append((cost + more, audit + edit))
                    for key in list(frontier):
                        frontier[key] = sorted(set(frontier[key]))[:40]
            ends = [label for state in leave for label in frontier.get((len(rows), state), [])]
            costs = min(ends, default=None)
            assert conversations.search(rows, 0, leave) == costs


def test_repaired_rows_are_legal(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    damaged = conversations.damaged(df)
    found = conversations.repairs(damaged)
    out = {}
    for r in sorted(conversations.repaired_rows(damaged, found).collect(), key=lambda r: (r.conv_id, r.place)):
        out[r.conv_id] = out.get(r.conv_id, "") + r.role[0]
        assert (r.edit == "Insert") == (r.text == "") and (r.edit != "Insert") == (r.turn is not None)
    import re

    assert out and all(re.fullmatch("(s?(ua)+)?", initials) for initials in out.values())


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pieces.multi_50k(), special_tokens={})


def marks(reference, text):
    ids, data = reference.encode_ordinary(text or ""), (text or "").encode()
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest()


AWKWARD = [
    None,
    "",
    " ",
    "\x00\x01\x7f ▁▁ <unk> <s> </s> <|endoftext|>",
    "it's WE'LL they'd  'S\n\n \r\n\t end ",
    "x" * 70_000,
    " " * 200_000 + "z",
    "12345678901234567890 ½ ² Ⅷ ٣",
    "日本語 ภาษาไทย العربية ​ é 👩‍👩‍👧 🇩🇪",
    "<unk><unk>",
    "  　\x1c\x1d\x85 a",
]


def test_round_trip_equals_the_library(spark, reference):
    ranks = byte_pieces.multi_50k()
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = given + [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "null id"), (1, "twice"), (1, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit("clash"))
    found = [tuple(r) for r in byte_pieces.round_trip(df, ranks).collect()]
    assert sorted(found, key=repr) == sorted(((d, *marks(reference, t)) for d, t in rows), key=repr)


def test_odd_and_empty_tables(spark, reference):
    ranks = byte_pieces.multi_50k()
    found = sorted((tuple(r) for r in byte_pieces.round_trip(odd(spark), ranks).collect()), key=repr)
    assert found == sorted(((r[0], *marks(reference, r[1])) for r in ODD), key=repr)
    assert byte_pieces.round_trip(empty(spark), ranks).collect() == []


def test_tokens_beyond_merges_are_taken_whole():
    """`abc` has no chain of merges; alone it is its own rank, inside other matches it never comes up. Ranks may have gaps."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"xy": 301, b"<unk>": 400}
    codec = byte_pieces.Codec(*byte_pieces.Codec.parts(ranks))
    library = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abc abcd xyxy", "abc" * 30, "<unk> <unk>", "aé中"):
        assert codec.ids([text])[0].tolist() == library.encode_ordinary(text)
        assert codec.decode(library.encode_ordinary(text)) == text.encode()


def test_nulls_and_unknown_ids(spark):
    ranks = byte_pieces.multi_50k()
    codec = byte_pieces.Codec(*byte_pieces.Codec.parts(ranks))
    df = spark.createDataFrame([(1, [codec.ids(["ab"])[0].tolist()[0]]), (2, None), (3, [])], "k long, ids array<int>")
    assert {r.k: r.decoded for r in byte_pieces.decode(df, ranks).collect()}[2] is None
    assert {r.k: r.decoded and bytes(r.decoded) for r in byte_pieces.decode(df, ranks).collect()}[3] == b""
    with pytest.raises(KeyError):
        codec.decode([10**6])
    with pytest.raises(ValueError):
        byte_pieces.Codec(*byte_pieces.Codec.parts({b"a": 0})).ids(["b"])
