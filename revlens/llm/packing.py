"""Packing of tokenised documents into sequences by exact-complement hashing.

Documents become pieces of at most `CAPACITY` tokens. How many pieces there are of each length is all the planner
needs: at most `CAPACITY` numbers, whatever the corpus. It fills each length's gap exactly with a single length, a
pair or a triple found by its sum, as often as the counts allow, and packs what is left best-fit. The plan is a list of
combinations and how often each is used; pieces are numbered within their length in parallel and look up their place.

Null and empty texts are documents of one token, the end mark. Repeated rows are packed once each. An empty table
gives no pieces. Columns other than doc_id and the text are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import one_by_one, staged, texts
from revlens.llm.tokens import Encoder

CAPACITY = 1024
END = 2
CHUNKS = 256


def pieces(docs: DataFrame, tokenizer: Callable[[], Encoder], text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. Of a longer document the first piece is the short one.

    `tokenizer()` makes the encoder, once in every task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer()
        for batch in one_by_one(batches):
            owner, number, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(encoder.encode(texts(batch.column(1)))):
                data = np.append(ids, end).astype("<u4")
                first = len(data) % capacity or capacity
                cuts = [0, *range(first, len(data) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    owner.append(row)
                    number.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(data[a:b].tobytes()))
            if owner:
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths, each fitting one sequence, and how often to use each, from the count of every length.

    Long lengths come first, because they have the fewest complements. For each, the sums of one, two and three
    shorter lengths that fill its gap are looked up among the lengths still there. What remains is packed from the
    longest down, each gap by the largest length that fits.
    """
    left = np.array(counts, np.int64)
    out: list[tuple[tuple[int, ...], int]] = []

    def use(combination: tuple[int, ...]) -> None:
        need: dict[int, int] = {}
        for length in combination:
            need[length] = need.get(length, 0) + 1
        times = min(int(left[length]) // n for length, n in need.items())
        if times:
            out.append((combination, times))
            for length, n in need.items():
                left[length] -= n * times

    for parts in (0, 1, 2, 3):
        for length in range(capacity, 0, -1):
            if not left[length]:
                continue
            gap = capacity - length
            if parts == 0 and gap == 0:
                use((length,))
            elif parts == 1 and gap:
                use((length, gap))
            elif parts == 2:
                for a in range(min(gap - 1, length), (gap + 1) // 2 - 1, -1):
                    if not left[length]:
                        break
                    if a > 0 and left[a] and left[gap - a]:
                        use((length, a, gap - a))
            elif parts == 3:
                there = np.flatnonzero(left[: gap + 1])
                for a in there[::-1]:
                    if not left[length]:
                        break
                    rest = gap - int(a)
                    smaller = there[(there <= min(a, rest - 1)) & (there * 2 >= rest)]
                    for b in smaller[left[rest - smaller] > 0][::-1]:
                        use((length, int(a), int(b), rest - int(b)))
                        if not left[length] or not left[a]:
                            break
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        combination, gap, spare = [longest], capacity - longest, left.copy()
        spare[longest] -= 1
        while gap:
            fitting = np.flatnonzero(spare[: gap + 1])
            if not len(fitting):
                break
            combination.append(int(fitting[-1]))
            spare[fitting[-1]] -= 1
            gap -= int(fitting[-1])
        use(tuple(combination))
    return out


def places(combinations: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> list[np.ndarray]:
    """For each length, rows (first rank, first sequence, offset): ranks from there on lie at that offset, one per sequence."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    used, sequence = [0] * (capacity + 1), 0
    for combination, times in combinations:
        offset = 0
        for length in combination:
            found[length].append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return [np.array(x, np.int64).reshape(len(x), 3) for x in found]


def numbered(cut: DataFrame) -> DataFrame:
    """Pieces with rank, their number within their length. Ranks are counted in slices, so that a common length is split."""
    sliced = cut.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(CHUNKS)).cast("int"))
    sizes = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("length", "_slice").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return sliced.withColumn("_inner", inner).join(starts, ["length", "_slice"]).withColumn("rank", F.col("_before") + F.col("_inner")).drop("_slice", "_before", "_inner")


def pack(docs: DataFrame, tokenizer: Callable[[], Encoder], text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, tokenizer, text, capacity, end), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # one row per length, `capacity` at most
        counts[length] = n
    where = places(plan(counts, capacity), capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                rows, table = lengths == length, where[length]
                at = np.searchsorted(table[:, 0], ranks[rows], side="right") - 1
                sequence[rows] = table[at, 1] + ranks[rows] - table[at, 0]
                offset[rows] = table[at, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered(cut).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
