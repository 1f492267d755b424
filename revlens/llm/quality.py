"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every text gets counts (`text_features`), every rule a vote from them: 1 for good, -1 for bad, 0 where it has
nothing to say. `fit_votes` counts how often each pattern of votes occurs over all documents and estimates, without
labels, how often documents are good and how each rule votes on good and on bad ones. A document is judged by the
posterior probability that it is good, so that one failed rule does not decide.

Null and empty texts have no words: every count is 0 and the base rule rejects them. Repeated rows are judged alike.
An empty table gives an empty result; its model is the starting one. Columns of the input that share a name with a
result column are replaced by it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import map_batches, pieces, staged, texts
from revlens.llm.kernel import SPACE, Texts, windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_upper", "n_stops", "n_symbol_words", "n_doubled")

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
DIGITS = np.isin(np.arange(256), np.arange(48, 58))
CAPITALS = np.isin(np.arange(256), np.arange(65, 91))
STOPS = np.isin(np.arange(256), np.frombuffer(b".,!?;:", np.uint8))


def _per_text(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, how many of its words are flagged."""
    running = np.concatenate([[0], np.cumsum(words)])
    return running[first[1:]] - running[first[:-1]]


def _repeated(flat: np.ndarray, width: int) -> int:
    """How many of the words lie in a run of `width` words that occurs twice or more."""
    if len(flat) <= width:
        return 0
    runs = windows(flat, width)
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    border = np.zeros(len(flat) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(border, at, 1)
    np.add.at(border, at + width, -1)
    return int((np.cumsum(border) > 0).sum())


def _dup_lines(t: Texts) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(t.bytes == 10)
    starts = np.concatenate([t.first[:-1], breaks + 1])
    owner = np.concatenate([np.arange(t.n), np.searchsorted(t.first, breaks, side="right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    last = np.append(owner[1:] != owner[:-1], True)
    ends = np.where(last, t.first[owner + 1], np.append(starts[1:], 0) - 1)
    worded = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, starts)
    starts, ends, owner = starts[worded], ends[worded], owner[worded]
    if not len(starts):
        return np.zeros(t.n, np.int64)
    hashes = t.hashes(starts, ends)
    order = np.lexsort((hashes, owner))
    again = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    return np.bincount(owner[order[1:]][again], minlength=t.n)


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of an Arrow column; bounded work arrays whatever the batch."""
    found: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    for start, stop in pieces(column):
        t = Texts(column.slice(start, stop - start))
        hashes, first = t.word_hashes(), t.word_first
        found["n_words"].append(np.diff(first))
        found["word_chars"].append(t.sums(t.inside & ((t.bytes & 0xC0) != 0x80)))
        found["n_symbols"].append(t.sums(SYMBOLS[t.bytes]))
        found["n_dup_lines"].append(_dup_lines(t))
        found["n_repeat_words"].append(np.array([_repeated(hashes[first[i] : first[i + 1]], 5) for i in range(t.n)], np.int64))
        found["n_lines"].append(t.sums(t.bytes == 10) + 1)
        found["n_digits"].append(t.sums(DIGITS[t.bytes]))
        found["n_upper"].append(t.sums(CAPITALS[t.bytes]))
        found["n_stops"].append(t.sums(STOPS[t.bytes]))
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[t.bytes])])
        found["n_symbol_words"].append(_per_text(symbols[t.ends] > symbols[t.starts], first))
        doubled = np.zeros(len(hashes), bool)
        doubled[1:] = hashes[1:] == hashes[:-1]
        doubled[first[:-1][first[:-1] < len(hashes)]] = False
        found["n_doubled"].append(_per_text(doubled, first))
    return {name: np.concatenate(parts).astype(np.int64) for name, parts in found.items()}


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns but the text, and the counts of `COUNTS`. Each text is read once and whole."""
    rest = [c for c in docs.columns if c != text and c not in COUNTS]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = counts(texts(batch.column(len(rest))))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), *(pa.array(found[c]) for c in COUNTS)], names=[*rest, *COUNTS])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for c in rest for f in [docs.schema[c]]]
    return map_batches(docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text)), run, ", ".join([*kept, *(f"{c} long" for c in COUNTS)]))


def _bad(condition: Column) -> Column:
    return F.when(condition, -1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over the counts: a rule votes against a document or abstains, and one votes for plain prose.

    Passing a rule says little for a document, so that most rules abstain then. Short texts and repeated runs of
    words are the base rule's matter.
    """
    words, chars = F.col("n_words"), F.col("word_chars")
    mean = F.when(words > 0, chars / words).otherwise(0.0)
    plain = (F.col("n_symbols") == 0) & (F.col("n_dup_lines") == 0) & (F.col("n_doubled") * 50 <= words)
    return {
        "word_length": _bad(~mean.between(3, 12)),
        "symbols": _bad(F.col("n_symbols") * 10 > words),
        "symbol_words": _bad(F.col("n_symbol_words") * 20 > words),
        "dup_lines": _bad(F.col("n_dup_lines") * 10 > F.col("n_lines") * 6),
        "doubled": _bad(F.col("n_doubled") * 10 > words),
        "digits": _bad(F.col("n_digits") * 2 > chars),
        "capitals": _bad(F.col("n_upper") * 10 > chars * 3),
        "stops": _bad((words >= 50) & (F.col("n_stops") * 200 < words)),
        "prose": F.when((words >= 50) & plain & (F.col("n_stops") * 50 >= words), 1).otherwise(0),
    }


@dataclass(frozen=True)
class VoteModel:
    """The share of good documents, and each rule's vote shares (bad, abstain, good) on good and on bad documents."""

    prior: float
    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]

    def log_odds(self, rules: dict[str, Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, g, b in zip(rules.values(), self.good, self.bad, strict=True):
            minus, none, plus = (math.log(x / y) for x, y in zip(g, b, strict=True))
            total = total + F.when(vote == 1, plus).when(vote == -1, minus).otherwise(none)
        return total


ANCHOR_GOOD, ANCHOR_BAD, ANCHOR_PRIOR = (0.05, 0.45, 0.5), (0.5, 0.45, 0.05), 0.9
ANCHOR_WEIGHT = 0.02


def fit_patterns(patterns: np.ndarray, weights: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and how often each occurs.

    It starts from rules that are right when they speak and from 90 % good documents. The same belief stays
    in every round with the weight of a fiftieth of the documents, so that classes cannot change sides and a rule that
    hardly ever speaks keeps sensible odds.
    """
    rules, belief = patterns.shape[1], ANCHOR_WEIGHT * weights.sum() + 1
    good, bad, prior = np.tile(ANCHOR_GOOD, (rules, 1)), np.tile(ANCHOR_BAD, (rules, 1)), ANCHOR_PRIOR
    hot = patterns[:, :, None] == np.array([-1, 0, 1])
    for _ in range(rounds if weights.sum() else 0):
        odds = math.log(prior / (1 - prior)) + (hot * np.log(good / bad)).sum(axis=(1, 2))
        posterior = 1 / (1 + np.exp(-odds))
        before = prior
        yes, no = weights * posterior, weights * (1 - posterior)
        prior = float((yes.sum() + belief * ANCHOR_PRIOR) / (weights.sum() + belief))
        good = ((hot * yes[:, None, None]).sum(axis=0) + belief * np.array(ANCHOR_GOOD)) / (yes.sum() + belief)
        bad = ((hot * no[:, None, None]).sum(axis=0) + belief * np.array(ANCHOR_BAD)) / (no.sum() + belief)
        if abs(prior - before) < 1e-12:
            break
    return VoteModel(prior, tuple(map(tuple, good.tolist())), tuple(map(tuple, bad.tolist())))


def fit_votes(features: DataFrame) -> VoteModel:
    """Fit on all rows. What reaches the driver is one row per pattern of votes, at most 3 to the number of rules."""
    rules = votes()
    seen = sorted((tuple(r)[:-1], r[-1]) for r in features.groupBy(*(v.alias(k) for k, v in rules.items())).count().collect())
    return fit_patterns(np.array([p for p, _ in seen]).reshape(len(seen), len(rules)), np.array([n for _, n in seen], float))


def judged(features: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Features with base_failed, posterior (probability of a good document) and kept."""
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    posterior = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.log_odds(votes())))
    return features.withColumns({"base_failed": failed, "posterior": posterior}).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def quality(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Judge every document: its columns but the text, the counts, base_failed, posterior, kept."""
    features = staged(text_features(docs, text), "quality")
    return judged(features, fit_votes(features), threshold)


def kept_documents(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that are kept, all columns. The model is fitted on all of them; verdicts are then made row by row."""
    model = fit_votes(text_features(docs.select(text), text))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = counts(texts(batch.column(0).field(text)))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c]) for c in COUNTS)], names=["doc", *COUNTS])

    counted = map_batches(whole, run, ", ".join([f"doc {whole.schema['doc'].dataType.simpleString()}", *(f"{c} long" for c in COUNTS)]))
    return judged(counted, model, threshold).where("kept").select("doc.*")
