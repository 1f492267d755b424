"""Edit-aware token counts: a segment tree of token sums over each document's pre-token segments.

A text is cut into segments of about `SEGMENT` characters at places where a new pre-token begins whatever stands
around: before a space that follows a visible ASCII character and precedes an ASCII letter. A segment's token count
does not depend on its neighbours, and the sums above it are a binary tree; the root is the document's count. An edit
re-encodes the segments it touches, and a neighbour whose border characters it may change, and updates the sums above
them; everything else is kept.

Null and empty texts have one empty segment and count 0. A text without a place to cut is one segment. Repeated rows
have trees of their own. Edits that are null, out of range, reversed or that overlap an earlier edit are refused: they
are left out and counted in `refused`. Empty tables give empty results. Other columns are not carried.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import one_by_one, texts
from revlens.llm.tokens import Encoder

SEGMENT = 256
CONTEXT = 2

_CUT = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The text cut at safe places, each segment as short as `size` allows."""
    out, start = [], 0
    while True:
        found = _CUT.search(text, start + size)
        if found is None:
            return [*out, text[start:]]
        out.append(text[start : found.start()])
        start = found.start()


def sums(leaves: list[int]) -> list[int]:
    """The tree as a heap: node 1 is the root, node i has children 2i and 2i + 1, leaves are the last half."""
    width = 1 << max(0, (len(leaves) - 1).bit_length())
    tree = [0] * (2 * width)
    tree[width : width + len(leaves)] = leaves
    for i in range(width - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def change(text: str, lengths: list[int], tree: list[int], edits: list[tuple[int, int, str]], count: Callable[[list[str]], list[int]]) -> tuple[str, list[int], list[int], int, int]:
    """The text, lengths and tree after the edits, the characters encoded again, and the edits refused.

    Edits (start, stop, replacement) refer to the text before any of them.
    """
    ends = np.cumsum(lengths).tolist()
    accepted, at, refused = [], 0, 0
    for start, stop, new in sorted(e for e in edits if e[0] is not None and e[1] is not None and e[2] is not None):
        if at <= start <= stop <= len(text):
            accepted.append((start, stop, new))
            at = stop
    refused = len(edits) - len(accepted)
    if not accepted:
        return text, lengths, tree, 0, refused
    regions: list[list] = []  # first segment, last segment, edits
    for edit in accepted:
        first = bisect.bisect_right(ends, max(0, edit[0] - CONTEXT))
        last = bisect.bisect_left(ends, min(len(text), edit[1] + CONTEXT))
        first, last = min(first, len(ends) - 1), min(last, len(ends) - 1)
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], last)
            regions[-1][2].append(edit)
        else:
            regions.append([first, last, [edit]])
    lengths, tree, width = list(lengths), list(tree), len(tree) // 2
    out, done, pending = [], 0, []
    for first, last, inside in regions:
        begin, end = ends[first] - lengths[first], ends[last]
        parts, position = [], begin
        for start, stop, new in inside:
            parts += [text[position:start], new]
            position = stop
        parts.append(text[position:end])
        fresh, slots = segments("".join(parts)), last - first + 1
        fresh = [*fresh[: slots - 1], "".join(fresh[slots - 1 :]), *[""] * (slots - len(fresh))][:slots]
        pending.append((first, fresh))
        out += [text[done:begin], *fresh]
        done = end
    out.append(text[done:])
    flat = [s for _, fresh in pending for s in fresh]
    counts = iter(count(flat))
    touched = set()
    for first, fresh in pending:
        for i, segment in enumerate(fresh, first):
            lengths[i], tree[width + i] = len(segment), next(counts)
            touched.add((width + i) // 2)
    while touched and 0 not in touched:  # one level of the tree at a time
        for i in touched:
            tree[i] = tree[2 * i] + tree[2 * i + 1]
        touched = {i // 2 for i in touched}
    return "".join(out), lengths, tree, sum(map(len, flat)), refused


def _counter(encoder: Encoder) -> Callable[[list[str]], list[int]]:
    return lambda parts: [len(encoder.ids(part)) for part in parts]


def trees(docs: DataFrame, tokenizer: Callable[[], Encoder], text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, lengths (characters per segment), tree, n_tokens, and the columns to keep. `tokenizer()` makes the encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer())
        for batch in one_by_one(batches):
            if not batch.num_rows:
                continue
            column = texts(batch.column(1))
            lengths, heaps = [], []
            for start in range(0, batch.num_rows, 64):  # a few texts at a time are cut and counted
                cut = [segments(t.as_py()) for t in column.slice(start, 64)]
                counts = count([s for parts in cut for s in parts])
                at = 0
                for parts in cut:
                    lengths.append([len(s) for s in parts])
                    heaps.append(sums(counts[at : at + len(parts)]))
                    at += len(parts)
            columns = [batch.column(0), column, pa.array(lengths, pa.list_(pa.int32())), pa.array(heaps, pa.list_(pa.int32())), pa.array([h[1] for h in heaps], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(i) for i in range(2, batch.num_columns))], names=["doc_id", "text", "lengths", "tree", "n_tokens", *keep])

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text), *keep).mapInArrow(run, f"doc_id {kind}, text string, lengths array<int>, tree array<int>, n_tokens long{kinds}")


def edited(built: DataFrame, tokenizer: Callable[[], Encoder], edits: str = "edits") -> DataFrame:
    """The trees after the edits in a column of (start, stop, replacement), offsets in characters: doc_id, text,
    lengths, tree, n_tokens, tokens_before, reencoded (characters) and refused (edits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer())
        for batch in one_by_one(batches):
            out = []
            for text, lengths, tree, wanted in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                wanted = [(e["start"], e["stop"], e["replacement"]) if e else (None, None, None) for e in wanted.as_py() or ()]
                out.append((tree[1].as_py(), *change(text.as_py(), lengths.as_py(), tree.as_py(), wanted, count)) if wanted else (tree[1].as_py(), text.as_py(), lengths.as_py(), tree.as_py(), 0, 0))
            if out:
                before, after, lengths, heaps, encoded, refused = zip(*out, strict=True)
                columns = [pa.array(after, pa.string()), pa.array(lengths, pa.list_(pa.int32())), pa.array(heaps, pa.list_(pa.int32()))]
                numbers = [pa.array(x, pa.int64()) for x in ([h[1] for h in heaps], before, encoded, refused)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *numbers], names=["doc_id", "text", "lengths", "tree", "n_tokens", "tokens_before", "reencoded", "refused"])

    kind = built.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, lengths array<int>, tree array<int>, n_tokens long, tokens_before long, reencoded long, refused long"
    return built.select("doc_id", "text", "lengths", "tree", edits).mapInArrow(run, schema)


_CLEAN = re.compile(r"(?P<number>[0-9]{7,})|(?P<email>(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)|(?P<symbols>[#*$%&|<>]{3,})")


def _cleaning(value: str | None) -> list[dict]:
    return [{"start": m.start(), "stop": m.end(), "replacement": m[0][0] if m.lastgroup == "symbols" else f"[{m.lastgroup}]"} for m in _CLEAN.finditer(value or "")]


def cleaning_edits(text: str) -> Column:
    """Edits that take out long digit runs and addresses and shorten runs of symbols: the production edit list."""

    @F.pandas_udf("array<struct<start:int,stop:int,replacement:string>>")
    def edits(values: pd.Series) -> pd.Series:
        return values.map(_cleaning, na_action=None)

    return edits(text)
