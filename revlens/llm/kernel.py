"""Words, lines and shingles of many texts at once, as flat numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, BASE))])
        _inverses = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, INVERSE))])
    return _powers, _inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """Bytes and word borders of a run of texts.

    `first` has the byte offset of every text and the end; `starts` and `ends` are the words' bytes;
    `word_first` the number of words before every text, and the total.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int32, count=self.n + 1, offset=4 * column.offset).astype(np.int64)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.first = offsets - offsets[0]
        self.bytes = LOWERED[raw] if lower else raw
        inside = ~SPACE[raw]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = self.first[:-1][self.first[:-1] < self.first[1:]]
        begins[edges] = inside[edges]
        edges = self.first[1:][self.first[:-1] < self.first[1:]] - 1
        stops[edges] = inside[edges]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.word_first = np.searchsorted(self.starts, self.first)
        self._sums = None

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range."""
        powers, inverses = _tables(len(self.bytes) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers[: len(self.bytes)], out=self._sums[1:])
        return mixed((self._sums[ends] - self._sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """For each text, the sum of a per-byte array."""
        running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return running[self.first[1:]] - running[self.first[:-1]]


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive word hashes; a shorter list gives one hash of the whole, an empty list none."""
    if len(words) == 0:
        return words
    size = min(k, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size * 0xA24BAED4963EE407 % (1 << 64)), np.uint64)
    factor = 1
    for i in range(size):
        factor = factor * 0x9FB21C651E98DF25 % (1 << 64)
        total += words[i : len(words) - size + 1 + i] * np.uint64(factor)
    return mixed(total)
