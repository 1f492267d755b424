"""Phrases that keep together, counted in tiles of frequency-ranked ids.

Texts become streams of ids in chunks of some megabytes, filled from many batches and kept compressed. Words are counted per language, those with `least` occurrences
are ranked by frequency and get dense ids, so that the pairs that matter most lie in the first tiles. Adjacent ids of a chunk are
pairs; the plane of pairs is cut into square tiles, a tile that a chunk fills well is counted directly by a dense bincount,
the others as sorted coordinates. Counts of chunks move by shares of the plane, each share of a chunk in few bytes, and are added share by share. Frequent pairs are ranked and get ids of their own, the stream
of a chunk is rewritten with them, and the pairs of that stream are phrases one word longer: a phrase of k words is the pair of its
first and its last k - 1 words. A part of a phrase is never rarer than the phrase, so nothing frequent is lost.

Ids of a chunk are looked up for its own distinct words or pairs, in one row for each share of all names that it has some of; a bit set
of fixed size leaves out those that are surely rare before they move. A share of the names of all chunks meets the same share of the
numbered ones; there are more shares where there are more chunks. No vocabulary is broadcast or collected.

Null texts are empty, null languages `und`. Texts and words are taken whole. Repeated rows count each time. Other columns are
not carried, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.bloom import bit_set, may_hold
from revlens.llm.common import map_batches, one_by_one, pieces, staged, texts
from revlens.llm.hilbert_shards import ranked
from revlens.llm.kernel import mixed
from revlens.operators.topk import top_per_group

LONGEST = 5
LEAST = 100
TOP = 2000
TILE = 1024
CHUNK = 8 << 20
WAITING = 2 * CHUNK  # bytes of all languages that a task holds until their chunks are full
BORDER = b"\n"
# A-Z become lower case, a tab a blank, and what ends a piece a line break.
READ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + BORDER * 9)
NONE = np.uint32(0xFFFFFFFF)
ADDED = 1 << 20  # counts of a share that a task holds unadded


def shut(stream: np.ndarray) -> bytes:
    """A stream in few bytes: frequent words have small ids, so that most high bytes are zero; equal places of all ids lie together."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(stream.astype(np.uint32, copy=False).view(np.uint8).reshape(-1, 4).T).tobytes())


def opened(data: pa.Scalar) -> np.ndarray:
    """The stream of `shut`."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.as_buffer()), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def chunks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """chunk, lang, n (words), stream (a local id per word and border, `shut`), words and counts by local id; id 0 is the border."""

    def chunk(number: int, lang: str, parts: list[bytes]) -> pa.RecordBatch:
        tokens = list(filter(None, b"\n".join(parts).replace(BORDER, b" \n ").split(b" ")))
        local: defaultdict[bytes, int] = defaultdict()
        local.default_factory = local.__len__
        local[BORDER]
        stream = np.fromiter(map(local.__getitem__, tokens), np.uint32, len(tokens))
        del tokens
        counts = np.bincount(stream, minlength=len(local))
        counts[0] = 0
        words = pa.array(local, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([shut(stream)], pa.binary()), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
            names=["chunk", "lang", "n", "stream", "words", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}

        def full(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            del held[lang]
            return chunk(number - 1, lang, waiting.pop(lang))

        for batch in one_by_one(batches):
            column, langs = texts(batch.column(0)), batch.column(1).fill_null("und")
            for one in langs.unique().to_pylist():
                of_lang = column.filter(pc.equal(langs, one))
                for start, stop in pieces(of_lang, CHUNK // 4):
                    data = b"\n".join(t.as_buffer().to_pybytes() for t in of_lang.slice(start, stop - start)).translate(READ)
                    if held.get(one, 0) + len(data) > CHUNK and one in held:
                        yield full(one)
                    waiting.setdefault(one, []).append(data)
                    held[one] = held.get(one, 0) + len(data)
                    del data
                    if sum(held.values()) > WAITING:
                        yield full(max(held, key=held.__getitem__))
        for one in list(held):
            yield full(one)

    return docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(run, "chunk long, lang string, n long, stream binary, words array<string>, counts array<long>")


def numbered(counted: DataFrame, key: str, name: str) -> DataFrame:
    """The counted rows with `id`: by language, the most frequent first, from 0 without gaps."""
    return ranked(counted.withColumn("_less", -F.col("a")), ["lang", "_less", key], name, "id").drop("_less")


def shares(streams: DataFrame) -> int:
    """The number of shares that names and pairs move in: with the root of the number of chunks, so that neither a share nor the number of its rows is large."""
    return 8 << math.isqrt(streams.count()).bit_length()


def marks(names: pa.Array, langs: pa.Array) -> np.ndarray:
    """A 64-bit hash of each name, a word or a pair, in its language; `langs` has one for all or one for each."""
    own, of_lang = (x.to_numpy().view(np.uint64) if pa.types.is_integer(x.type) else pd.util.hash_array(x.to_numpy(zero_copy_only=False).astype(object), categorize=False) for x in (names, langs))
    return mixed(own ^ mixed(of_lang))


def dealt(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shares that occur, in order, and where each begins in the sorted shares, with the end."""
    used, starts = np.unique(share, return_index=True)
    return used.astype(np.int32), np.append(starts, len(share)).astype(np.int32)


def share_of(mark: np.ndarray, parts: int) -> np.ndarray:
    """The share of each mark; a bit set tells marks by other bits."""
    return (mark >> np.uint64(32)) % np.uint64(parts)


def looked_up(asking: DataFrame, known: DataFrame, parts: int, first: int = 0, sure: bool = False) -> DataFrame:
    """chunk and names, `shut` numbers and ids of the names of `asking` (chunk, lang, names) that are in `known` (lang, name, id).

    A name's number is its place in `names`, from `first` on. Unless they are `sure`, names that are surely unknown stay where they are.
    """
    kind = known.schema["name"].dataType.simpleString()

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = marks(batch.column(1), batch.column(0))
        return pa.RecordBatch.from_arrays([pa.array(share_of(found, parts).astype(np.int32)), pa.array(found.view(np.int64)), *batch.columns], names=["share", "mark", "lang", "name", "id"])

    marked = map_batches(known.select("lang", "name", "id"), mark, f"share int, mark long, lang string, name {kind}, id long")
    bits = None if sure else asking.sparkSession.sparkContext.broadcast(bit_set(marked, "mark"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for i in range(batch.num_rows):
                names, lang = batch.column(2)[i].values, batch.column(1).slice(i, 1)
                mark = marks(names, lang)
                at = np.arange(len(names)) if bits is None else np.flatnonzero(may_hold(bits.value, mark.view(np.int64)))
                share = share_of(mark[at], parts)
                order = np.argsort(share, kind="stable")
                at, (used, ends) = at[order], dealt(share[order])
                one = pa.array(np.zeros(len(used), np.int32))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array((at + first).astype(np.int32)), names.take(pa.array(at)))]
                yield pa.RecordBatch.from_arrays([pa.array(used), batch.column(0).slice(i, 1).take(one), lang.take(one), *lists], names=["share", "chunk", "lang", "at", "names"])

    def answer(asked: pa.Table, named: pa.Table) -> pa.Table:
        found, out = [], []
        for lang in asked["lang"].unique().to_pylist():
            rows, ids = (x.filter(pc.equal(x["lang"], lang)).combine_chunks() for x in (asked, named))
            if not ids.num_rows:
                continue
            if pc.max(ids["id"]).as_py() >= NONE:
                raise OverflowError("more frequent phrases than 32-bit ids")
            place = pc.index_in(pc.list_flatten(rows["names"]), value_set=ids["name"].combine_chunks())
            known = pc.is_valid(place).to_numpy(zero_copy_only=False)
            id_of, at = ids["id"].to_numpy()[pc.fill_null(place, 0).to_numpy()], pc.list_flatten(rows["at"]).to_numpy()
            ends = np.cumsum(pc.list_value_length(rows["names"]).to_numpy())
            for chunk, start, stop in zip(rows["chunk"].to_pylist(), [0, *ends[:-1]], ends, strict=True):
                hit = start + np.flatnonzero(known[start:stop])
                if len(hit):
                    found.append(chunk)
                    out.append(shut(np.concatenate([at[hit].astype(np.uint32), id_of[hit].astype(np.uint32)])))
        return pa.table([pa.array(found, pa.int64()), pa.array(out, pa.binary())], names=["chunk", "names"])

    asked = asking.select("chunk", "lang", "names").mapInArrow(ask, f"share int, chunk long, lang string, at array<int>, names array<{kind}>")
    return asked.groupBy("share").cogroup(marked.select("share", "lang", "name", "id").groupBy("share")).applyInArrow(answer, "chunk long, names binary")


def renamed(streams: DataFrame, named: DataFrame) -> DataFrame:
    """chunk and stream with every local number replaced by its id from `named` (`looked_up`); those without one become NONE."""
    found = named.groupBy("chunk").agg(F.collect_list("names").alias("names"))  # no more than the chunk's distinct numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for i in range(batch.num_rows):
                stream = opened(batch.column(1)[i])
                names = np.full(int(stream.max(initial=0)) + 1, NONE, np.uint32)
                for one in batch.column(2)[i].values:
                    at, ids = opened(one).reshape(2, -1)
                    names[at] = ids
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([shut(names[stream])], pa.binary())], names=["chunk", "stream"])

    return streams.select("chunk", "stream").join(found, "chunk").select("chunk", "stream", "names").mapInArrow(run, "chunk long, stream binary")


def stream_pairs(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places where two ids stand side by side, and the pairs as 64-bit numbers."""
    places = np.flatnonzero((stream[:-1] != NONE) & (stream[1:] != NONE))
    return places, (stream[places].astype(np.uint64) << np.uint64(32)) | stream[places + 1]


def tile_counts(pairs: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and their counts, tile by tile: densely where a tile has as many pairs as an eighth of its cells, else by sorting.

    Tiles without many pairs are sorted together, because a coordinate tells its tile.
    """
    if len(pairs) == 0:
        return pairs, np.zeros(0, np.int64)
    left, right = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
    size = np.uint64(tile)
    across = int(right.max()) // tile + 1
    number = (left // size * np.uint64(across) + right // size).astype(np.int64)
    tiles, place, held = np.unique(number, return_inverse=True, return_counts=True)
    dense = held * 8 >= tile * tile
    keys, counts = [], []
    for t in np.flatnonzero(dense):
        inside = place == t
        cells = np.bincount((left[inside] % size * size + right[inside] % size).astype(np.int64), minlength=tile * tile)
        used = np.flatnonzero(cells)
        top, side = int(tiles[t]) // across * tile, int(tiles[t]) % across * tile
        keys.append(((used // tile + top).astype(np.uint64) << np.uint64(32)) | (used % tile + side).astype(np.uint64))
        counts.append(cells[used])
    found, n = np.unique(pairs[~dense[place]], return_counts=True)
    return np.concatenate([*keys, found]), np.concatenate([*counts, n])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def pair_counts(streams: DataFrame, least: int, parts: int) -> DataFrame:
    """key and a, the occurrences, of the pairs that occur `least` times or more in all streams.

    The right ids of a left one go to the shares in strips, so that frequent words do not meet in one share. A share of a chunk is its sorted
    pairs as steps of the left ids, right ids and counts, `shut`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for stream in batch.column(0):
                keys, counts = tile_counts(stream_pairs(opened(stream))[1])
                share = share_of(mixed(keys // np.uint64(TILE)), parts)
                order = np.lexsort((keys, share))
                (used, ends), keys, counts = dealt(share[order]), keys[order], counts[order]
                left, right = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)
                packed = [shut(np.concatenate([np.diff(left[a:b], prepend=np.uint32(0)), right[a:b], counts[a:b].astype(np.uint32)])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(packed, pa.binary())], names=["share", "pairs"])

    def add(share: pa.Table) -> pa.Table:
        keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for pairs in share["pairs"]:
            steps, right, n = opened(pairs).reshape(3, -1)
            keys.append((np.cumsum(steps, dtype=np.uint64) << np.uint64(32)) | right)
            counts.append(n.astype(np.int64))
            held += len(n)
            if held > ADDED:
                (key, a), held = summed(np.concatenate(keys), np.concatenate(counts)), 0
                keys, counts = [key], [a]
        key, a = summed(np.concatenate(keys), np.concatenate(counts))
        return pa.table([pa.array(key[a >= least].view(np.int64)), pa.array(a[a >= least])], names=["key", "a"])

    counted = streams.select("stream").mapInArrow(run, "share int, pairs binary")
    return counted.groupBy("share").applyInArrow(add, "key long, a long")


def local_pairs(streams: DataFrame, frequent: DataFrame) -> DataFrame:
    """chunk, stream and keys: pairs in reading order by local number, and the pair of every number from 1 on.

    Pairs that are surely not in `frequent` are left out; 0 stands between pairs that do not overlap.
    """

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(mixed(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], names=["mark"])

    bits = streams.sparkSession.sparkContext.broadcast(bit_set(map_batches(frequent.select("key"), mark, "mark long"), "mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for i in range(batch.num_rows):
                places, pairs = stream_pairs(opened(batch.column(1)[i]))
                keep = may_hold(bits.value, mixed(pairs).view(np.int64))
                places, pairs = places[keep], pairs[keep]
                if len(pairs):
                    keys, numbers = np.unique(pairs, return_inverse=True)
                    stream = np.insert(numbers.astype(np.uint32) + np.uint32(1), np.flatnonzero(np.diff(places) > 1) + 1, np.uint32(0))
                    columns = [pa.array([shut(stream)], pa.binary()), pa.array([keys.view(np.int64)], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *columns], names=["chunk", "stream", "keys"])

    return streams.mapInArrow(run, "chunk long, stream binary, keys array<long>")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... words, and lang and n, the occurrences of all words.

    A phrase has id, lang, phrase, last (word), a (its occurrences), heads and tails (those of its first and last 1, 2, ... words), and from
    two words on left and right, the ids of the phrases without its last and first word.
    """
    read = staged(chunks(docs, text, lang), "chunks")
    total = read.groupBy("lang").agg(F.sum("n").alias("n"))
    spelled = read.select("lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "word")).where("at > 0").select("lang", "word.words", "word.counts")
    counted = spelled.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("a")).where(F.col("a") >= least)
    level = numbered(counted, "phrase", "words").select("id", "lang", "phrase", F.col("phrase").alias("last"), "a", F.array("a").alias("heads"), F.array("a").alias("tails"))
    parts = shares(read)
    named = looked_up(read.select("chunk", "lang", F.col("words").alias("names")), level.select("lang", F.col("phrase").alias("name"), "id"), parts)
    streams = staged(renamed(read, named), "streams")
    levels = [level]
    for size in range(2, longest + 1):
        pairs = staged(pair_counts(streams, least, parts), "pairs")
        if pairs.isEmpty():
            break
        left = level.select(F.col("id").alias("left"), "lang", "phrase", "heads")
        right = level.select(F.col("id").alias("right"), "last", "tails")
        built = (
            pairs.withColumns({"left": F.shiftrightunsigned("key", 32), "right": F.col("key").bitwiseAND(0xFFFFFFFF)})
            .join(left, "left")
            .join(right, "right")
            .select("key", "left", "right", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a", F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"))
        )
        level = numbered(built, "key", "phrases")
        levels.append(level)
        if size < longest:
            local = staged(local_pairs(streams, level), "pair_streams")
            any_lang = F.lit("").alias("lang")  # ids tell it
            named = looked_up(local.select("chunk", any_lang, F.col("keys").alias("names")), level.select(any_lang, F.col("key").alias("name"), "id"), parts, first=1, sure=True)
            streams = staged(renamed(local, named), "streams")
    return levels, total


def _cuts(size: int) -> Column:
    """The cut of the lowest score, the shortest first part on ties, as a struct of score, l and r."""

    def whole(column: Column) -> Column:
        return column.cast("decimal(38,0)")

    cuts = []
    for k in range(1, size):
        l, r = F.col("heads")[k - 1], F.col("tails")[size - k - 1]
        score = F.call_function("div", whole(whole(F.col("a")) * whole(F.col("n"))) * 1000, whole(l) * whole(r))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first phrases by score, occurrences and spelling.

    The score of a cut is floor(1000 * a * n / (l * r)), in exact arithmetic; a phrase has that of its lowest cut. A phrase inside a
    longer one that is as frequent is left out. One word more is enough to look at: between a phrase and a longer one
    around it no phrase is rarer than the longer one.
    """
    levels, total = phrases(docs, least, longest, text, lang)
    scored = []
    for size, level in enumerate(levels[1:], 2):
        if size < len(levels):
            longer, end = levels[size], -2
            around = [longer.where(F.col("a") >= F.element_at(parts, end)).select(F.col(part).alias("id")) for part, parts in (("left", "heads"), ("right", "tails"))]
            level = level.join(around[0].union(around[1]), "id", "left_anti")
        cut = level.join(total, "lang").withColumn("cut", _cuts(size))
        scored.append(cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    if not scored:
        return levels[0].join(total, "lang").select("lang", F.lit(1).cast("long").alias("rank"), "phrase", "a", *(F.col("a").alias(c) for c in "lr"), "n", F.col("a").alias("score")).limit(0)
    every = scored[0]
    for more in scored[1:]:
        every = every.union(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_per_group(every, ["lang"], order, top, spread=True, slices=64).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
