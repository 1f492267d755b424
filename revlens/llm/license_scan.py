"""License scan: an exact set-similarity join between text blocks and license templates.

A block is a line of a text, as the set of its words; a template is the set of the words of a license notice. A block
meets a template if it has at least `THRESHOLD` of the template's words. Tokens are ordered by how many blocks of the
whole corpus have them, rarest first. A block that meets a template shares one of the template's first tokens (prefix),
has enough tokens of templates at all (length), and has enough tokens left on both sides from the first shared one on
(position); what passes is counted exactly. Words that no template has cannot count, so that a block is represented
by its template words; the index is as small as the templates, which are the caller's list.

With `windows`, a block is any run of consecutive words, whatever line breaks are in it, so that a wrapped notice is found
and words scattered over a long line are not. A run is as long as the template's notice over the threshold, so that
it holds the notice and the words that may be put into it. The rarest token of a run that meets a template is one of the
template's first (prefix); only the runs around such a token are looked at, if the text has enough tokens (length) and
enough that are no rarer stand around it (position). Among them every run is counted exactly.

Beside that, places where the words of given phrases stand consecutively are found in the whole text.

Null and empty texts have no words, no places and score 0. Repeated rows give repeated results. Templates that tie
give all their labels. An empty table gives an empty result. Columns other than doc_id and the text are not carried.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import LOWER, UPPER, one_by_one, texts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

# Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Notices of well-known licenses, as label and text.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)

_TABLE = str.maketrans(UPPER, LOWER)
_WORD = re.compile(WORD)


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_TABLE))


def places(found: list[str], phrase: list[str]) -> list[int]:
    """The word numbers, from 0, at which the phrase's words stand consecutively."""
    joined, wanted = " " + " ".join(found) + " ", " " + " ".join(phrase) + " "
    out, at, seen, number = [], joined.find(wanted), 0, 0
    while at >= 0:
        number += joined.count(" ", seen, at)
        seen = at
        out.append(number)
        at = joined.find(wanted, at + 1)
    return out


def block_frequencies(docs: DataFrame, tokens: frozenset[str], text: str = "text") -> dict[str, int]:
    """In how many blocks of all documents each of the tokens stands. Counted per batch before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            counts: Counter[str] = Counter()
            for value in texts(batch.column(0)):
                for line in value.as_py().split("\n"):
                    counts.update(tokens.intersection(words(line)))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])

    counted = docs.select(text).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n"))
    return {t: 0 for t in tokens} | dict(map(tuple, counted.collect()))  # one row per token of the templates


class TemplateIndex:
    """Prefixes of the templates by token, under a global order of the tokens."""

    def __init__(self, templates: tuple[tuple[str, str], ...], frequencies: dict[str, int], threshold: float):
        self.rank = {t: i for i, t in enumerate(sorted(frequencies, key=lambda t: (frequencies[t], t)))}
        self.templates = [(label, sorted({self.rank[w] for w in words(body)})) for label, body in templates if words(body)]
        self.need = [max(1, -(-len(t) * round(threshold * 1000) // 1000)) for _, t in self.templates]
        self.least = min(self.need, default=1)
        self.lengths = [-(-len(words(body)) * 1000 // max(1, round(threshold * 1000))) for _, body in templates if words(body)]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for k, (_, tokens) in enumerate(self.templates):
            for i, token in enumerate(tokens[: len(tokens) - self.need[k] + 1]):
                self.prefix.setdefault(token, []).append((k, i))

    def matches(self, found: list[str]) -> list[tuple[str, float]]:
        """(label, containment) of every template that the block's words meet."""
        block = sorted({self.rank[w] for w in found if w in self.rank})
        if len(block) < self.least:
            return []
        candidates: dict[int, bool] = {}
        for j, token in enumerate(block):
            for k, i in self.prefix.get(token, ()):
                if k not in candidates:
                    candidates[k] = min(len(self.templates[k][1]) - i, len(block) - j) >= self.need[k]
        out, there = [], set(block)
        for k, passed in candidates.items():
            label, tokens = self.templates[k]
            common = len(there.intersection(tokens)) if passed else 0
            if common >= self.need[k]:
                out.append((label, common / len(tokens)))
        return out

    def window_matches(self, found: list[str]) -> list[tuple[int, str, float]]:
        """(first word, label, containment) of the runs of words that meet a template; of runs that begin at consecutive
        words, the best, and the first of these."""
        hits = [(at, self.rank[w]) for at, w in enumerate(found) if w in self.rank]
        there = {token for _, token in hits}
        if len(there) < self.least:
            return []
        anchors: dict[int, set[int]] = {}
        for token in there:
            for k, _ in self.prefix.get(token, ()):
                anchors.setdefault(k, set()).add(token)
        out = []
        for k, rare in sorted(anchors.items()):
            label, tokens = self.templates[k]
            if len(there.intersection(tokens)) < self.need[k]:
                continue
            wanted, length = set(tokens), self.lengths[k]
            own = [hit for hit in hits if hit[1] in wanted]
            ranges: list[list[int]] = []  # of first words, merged
            for at, token in own:
                if token not in rare:
                    continue
                around = own[bisect_left(own, (at - length + 1, -1)) : bisect_left(own, (at + length, -1))]
                if len({t for _, t in around if t >= token}) < self.need[k]:
                    continue
                low, high = max(0, min(at - length + 1, len(found) - length)), max(0, min(at, len(found) - length))
                if ranges and low <= ranges[-1][1] + 1:
                    ranges[-1][1] = max(high, ranges[-1][1])
                else:
                    ranges.append([low, high])
            for low, high in ranges:
                out += [(at, label, common / len(tokens)) for at, common in self._best_of_runs(own, low, high, k)]
        return out

    def _best_of_runs(self, own: list[tuple[int, int]], low: int, high: int, k: int) -> Iterator[tuple[int, int]]:
        """(first word, common tokens) of the best window of each stretch of first words in low..high that pass."""
        counts: Counter[int] = Counter()
        left = right = bisect_left(own, (low, -1))
        best: tuple[int, int] | None = None
        for first in range(low, high + 1):
            while right < len(own) and own[right][0] < first + self.lengths[k]:
                counts[own[right][1]] += 1
                right += 1
            while left < right and own[left][0] < first:
                counts[own[left][1]] -= 1
                if not counts[own[left][1]]:
                    del counts[own[left][1]]
                left += 1
            if len(counts) >= self.need[k]:
                if best is None or len(counts) > best[1]:
                    best = (first, len(counts))
            elif best is not None:
                yield best
                best = None
        if best is not None:
            yield best


def license_scan(docs: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = THRESHOLD, windows: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and matches, the blocks
    (line number from 0, label, containment) that meet a template; with `windows`, runs of words by their first word. Score is the best containment among them, else 0."""
    tokens = frozenset(w for _, body in templates for w in words(body))
    index = TemplateIndex(templates, block_frequencies(docs, tokens, text), threshold)
    wanted = [(words(phrase), label) for phrase, label in phrases]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<block:int,label:string,containment:double>>"
    match_type = pa.list_(pa.struct([("block", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))

    def scan(value: str) -> tuple:
        found = words(value)
        base = [(at, label) for phrase, label in wanted for at in places(found, phrase)]
        matches = []
        if windows:
            matches = [{"block": at, "label": label, "containment": share} for at, label, share in index.window_matches(found)]
        elif len(index.rank.keys() & set(found)) >= index.least:
            for number, line in enumerate(value.split("\n")):
                matches += [{"block": number, "label": label, "containment": share} for label, share in index.matches(words(line))]
        starts, own = [at for at, _ in base], {label for _, label in base}
        labels = own | {m["label"] for m in matches}
        return (len(found), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), max((m["containment"] for m in matches), default=0.0), matches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), match_type]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
        for batch in one_by_one(batches):
            if batch.num_rows:
                columns = zip(*(scan(v.as_py()) for v in texts(batch.column(1))), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *names])

    return docs.select("doc_id", text).mapInArrow(run, schema)
