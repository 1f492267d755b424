"""N-gram Jaccard join by parity sketches.

A text's set is its distinct runs of `width` words. The parity sketch of a set has a row of bits for each of m bands;
every element falls into one band and flips one bit of it, so that elements two sets share cancel and the bits that
differ never outnumber the elements that differ. Two sets that link differ in at most D elements, so at most D bands
differ and at least m - D are equal: sets that link share the sketch of a whole band.

Bands belong to layouts by set size. A set of size n is in the layout of its size, and in the next one if a partner
may be there, so that partners always meet in a layout. A set emits its D + 1 fullest bands only, equally full ones by
their keys. Of the m - D or more bands that are equal for two linked sets, the first in this order is among the D + 1 first of both, because
at most D other bands come before it and equal bands have equal places in the order; no link is lost. A band's sketch is wide (2**64
places for a bit) and carried as the XOR of a hash of each place; a narrow sketch with about a bit for an element (256 to 4,096, a power
of two by the size of the set, folded to the narrower of two) travels along for the bound by Hamming distance. Candidates
that pass the bounds are compared element by element (64-bit hashes).

Sets are known by a 64-bit fingerprint, so that copies are one set. Members of a band's bucket are first compared with
its centre, the member that meets most others over all its buckets, which in a group of edited copies is what they were copied
from; where they link, one component has them all, and only members of different components are
compared with each other, large buckets in pairs of slices.

Null, empty and blank texts have an empty set and link with nothing. Repeated rows and repeated ids are rows of
one set. A null doc_id takes part and is never chosen as component_id unless its whole component has none. An empty
table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.bloom import bit_set, held, may_hold
from revlens.llm.common import components, one_by_one, pieces, staged, texts
from revlens.llm.kernel import Texts, mixed, windows

WIDTH = 4
THRESHOLD = 85
NARROWEST, WIDEST = 256, 4096
SLICE = 2048
LOWS = 8


def layouts(threshold: int, largest: int = 1 << 40) -> np.ndarray:
    """The smallest size of every layout; each is 1.6 times the one before."""
    out = [1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 8 // 5), 6 if len(out) == 1 else 0))
    return np.array(out, np.int64)


def most_different(n: int, threshold: int) -> int:
    """How many elements can differ between a set of n and any set that links with it.

    With d elements different and the larger set holding all others, 100 * (n - x) >= threshold * (n - x + d) holds for no d above this.
    """
    return n * (100 - threshold) // threshold


def most_different_within(largest: int, threshold: int) -> int:
    """How many elements can differ between two linked sets that both have `largest` elements at most."""
    return 2 * largest * (100 - threshold) // (100 + threshold)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct runs of `width` words, ascending."""
    runs = np.sort(windows(words, width))
    if len(runs) < 2:
        return runs
    return runs[np.append(True, runs[1:] != runs[:-1])]


def fingerprint(elements: np.ndarray) -> int:
    """A 64-bit number of the set, the same for every order."""
    total = mixed(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) if len(elements) else np.uint64(0)
    return int(mixed(np.array([total ^ np.uint64(len(elements))], np.uint64)).view(np.int64)[0])


def narrow_sketch(elements: np.ndarray) -> bytes:
    """The parity of the number of elements at each place, of as many places as the set's size asks for."""
    width = min(WIDEST, max(NARROWEST, 1 << (len(elements) - 1).bit_length()))
    place = ((elements >> np.uint64(24)) % np.uint64(width)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(sketches: list[bytes], places: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, all with so many places: a wider one's halves are laid over each other."""
    out = np.empty((len(sketches), places // 64), np.uint64)
    lengths = np.array([len(x) for x in sketches]) * 8
    for width in np.unique(lengths):
        of_width = np.flatnonzero(lengths == width)
        words = np.frombuffer(b"".join([sketches[i] for i in of_width]), np.uint64).reshape(len(of_width), width // places, places // 64)
        out[of_width] = np.bitwise_xor.reduce(words, axis=1)
    return out


def band_keys(elements: np.ndarray, threshold: int, sizes: np.ndarray) -> np.ndarray:
    """The keys of the bands that a set emits, one 64-bit number each."""
    n = len(elements)
    most = most_different(n, threshold)
    if most == 0:
        return np.zeros(0, np.int64)  # it links only with equal sets, which are one set here
    own = int(np.searchsorted(sizes, n, side="right")) - 1
    flips = mixed(elements ^ np.uint64(0x2545F4914F6CDD1D))
    out = []
    for layout in (own, own + 1):
        if layout > own and 100 * n < threshold * int(sizes[layout]):
            continue
        within = most_different_within(int(sizes[layout + 1]) - 1, threshold)
        bands = (within + 1) * 23 // 20 + 3
        band = ((elements >> np.uint64(32)) * np.uint64(bands) >> np.uint64(32)).astype(np.int64)
        fill = np.bincount(band, minlength=bands)
        must = min(most, within) + 1
        sketch = np.zeros(bands, np.uint64)
        first = np.append(True, band[1:] != band[:-1])
        sketch[band[first]] = np.bitwise_xor.reduceat(flips, np.flatnonzero(first))
        label = (np.uint64(layout) << np.uint64(48)) + np.arange(1, bands + 1, dtype=np.uint64)
        keys = mixed(sketch ^ mixed(label)).view(np.int64)
        out.append(keys[np.lexsort((keys, -fill))[:must]])
    return np.concatenate(out)


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets of a column, a few texts at a time: the first row's number and a list."""
    for start, stop in pieces(column):
        t = Texts(column.slice(start, stop - start), lower=True)
        words, first = t.word_hashes(), t.word_first
        yield start, [shingle_set(words[first[i] : first[i + 1]], width) for i in range(t.n)]


def sketches(docs: DataFrame, text: str, width: int, threshold: int) -> DataFrame:
    """doc_id, n_shingles, set_id (null for an empty set), sketch and keys; of copies in one task only the first has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, seen = layouts(threshold), set()
        for batch in one_by_one(batches):
            for start, sets in _sets(texts(batch.column(1)), width):
                n, ids, narrow, keys = [], [], [], []
                for elements in sets:
                    n.append(len(elements))
                    ids.append(fingerprint(elements) if len(elements) else None)
                    new = len(elements) > 0 and ids[-1] not in seen
                    if new:
                        seen.add(ids[-1])
                    narrow.append(narrow_sketch(elements) if new else None)
                    keys.append(band_keys(elements, threshold, sizes) if new else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(sets)), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(narrow, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_id", "sketch", "keys"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id long, sketch binary, keys array<long>")


def wanted_sets(docs: DataFrame, text: str, width: int, wanted: np.ndarray) -> DataFrame:
    """set_id and elements of the sets that the bit set may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in one_by_one(batches):
            for _, some in _sets(texts(batch.column(0)), width):
                ids, sets = [], []
                for elements in some:
                    if len(elements):
                        one = fingerprint(elements)
                        if one not in seen and may_hold(shared.value, np.array([one], np.int64))[0]:
                            seen.add(one)
                            ids.append(one)
                            sets.append(elements.tobytes())
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["set_id", "elements"])

    return docs.select(text).mapInArrow(run, "set_id long, elements binary")


def _linked(sizes_a: np.ndarray, sizes_b: np.ndarray, differing: np.ndarray, threshold: int) -> np.ndarray:
    """Whether sets of these sizes link if `differing` elements differ: 100 * common >= threshold * union, doubled."""
    return 100 * (sizes_a + sizes_b - differing) >= threshold * (sizes_a + sizes_b + differing)


def _differing(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The Hamming distance of each two sketches, at the places of the narrower one."""
    widths = np.minimum([len(x) for x in left], [len(x) for x in right]) * 8
    out = np.zeros(len(left), np.int64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        a, b = (folded([side[i] for i in rows], int(width)) for side in (left, right))
        out[rows] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return out


def bounded(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that sizes and the Hamming distance of the narrow sketches leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            if batch.num_rows:
                differing = _differing(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
                na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
                keep = pa.array(_linked(na, nb, np.maximum(differing, np.abs(na - nb)), threshold))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    left = nodes.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sets meet the threshold, compared whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            keep = []
            for x, y in zip(batch.column("ea"), batch.column("eb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            if keep:
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    left = sets.select(F.col("set_id").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("set_id").alias("b"), F.col("elements").alias("eb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _across(members: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of sets in one bucket, of different components, that sizes and narrow sketches leave.

    Members come as (key, i, j, part, set_id, n, sketch, lows, component): a bucket is cut into slices, and a pair of
    slices (i, j) meets in one task, where slice i is compared with slice j in blocks of numpy arrays. Linked sets share
    many buckets; where the smallest keys of both (lows) have a smaller key in common, that bucket gives the pair.
    """

    def pairs(part: dict[str, np.ndarray], key: int, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = np.flatnonzero(part["part"] == i)
        right = np.flatnonzero(part["part"] == j)
        for start in range(0, len(left), 64):
            rows = left[start : start + 64]
            differing = np.bitwise_count(part["sketch"][rows][:, None, :] ^ part["sketch"][right][None, :, :]).sum(axis=2, dtype=np.int64)
            na, nb = part["n"][rows][:, None], part["n"][right][None, :]
            good = _linked(na, nb, np.maximum(differing, np.abs(na - nb)), threshold) & (part["component"][rows][:, None] != part["component"][right][None, :])
            if i == j:
                good &= part["set_id"][rows][:, None] < part["set_id"][right][None, :]
            x, y = np.nonzero(good)
            x, y = rows[x], right[y]
            lows = part["lows"][x]
            earlier = ((lows[:, :, None] == part["lows"][y][:, None, :]) & (lows < key)[:, :, None]).any(axis=(1, 2))
            yield part["set_id"][x[~earlier]], part["set_id"][y[~earlier]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        seen: set[tuple[int, int]] = set()

        def flush() -> Iterator[pa.RecordBatch]:
            part = {c: np.concatenate([h[c] for h in held]) for c in held[0] if c != "sketch"}
            sketches = [x for h in held for x in h["sketch"]]
            part["sketch"] = folded(sketches, 8 * min(map(len, sketches)))
            _, once = np.unique(np.stack([part["part"], part["set_id"]]), axis=1, return_index=True)
            part = {c: v[once] for c, v in part.items()}
            if part["component"].min() == part["component"].max():
                return
            for x, y in pairs(part, int(part["key"][0]), int(part["i"][0]), int(part["j"][0])):
                new = [p for p in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True) if p not in seen]
                seen.update(new)
                if len(seen) > 1_000_000:  # only repeats are lost with it; the pairs become distinct later
                    seen.clear()
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*new, strict=True)], names=["a", "b"])

        for batch in one_by_one(batches):
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in ("key", "i", "j", "part", "set_id", "n", "component")}
            rows["sketch"] = batch.column("sketch").to_pylist()
            rows["lows"] = batch.column("lows").flatten().to_numpy().reshape(batch.num_rows, LOWS)
            change = (rows["key"][1:] != rows["key"][:-1]) | (rows["i"][1:] != rows["i"][:-1]) | (rows["j"][1:] != rows["j"][:-1])
            borders = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(borders, borders[1:], strict=False):
                here = {c: v[a:b] for c, v in rows.items()}
                if held and any(held[-1][c][0] != here[c][0] for c in ("key", "i", "j")):
                    yield from flush()
                    held.clear()
                held.append(here)
        if held:
            yield from flush()

    order = ["key", "i", "j"]
    return members.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def jaccard_classes(docs: DataFrame, text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, set_id, component (the smallest set_id reachable by links) and component_id (the smallest
    doc_id reachable) of every document. set_id and component are null for an empty set.

    Two documents link when 100 * common shingles >= threshold * shingles of either.
    """
    rows = staged(sketches(docs, text, width, threshold), "sketches")
    known = rows.where("set_id IS NOT NULL")
    lows = F.slice(F.concat(F.array_sort("keys"), F.array_repeat(F.lit((1 << 63) - 1), LOWS)), 1, LOWS)
    nodes = staged(known.groupBy("set_id").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"), F.max(lows).alias("lows")), "sets")
    bands = known.where("size(keys) > 0").select("set_id", F.explode("keys").alias("key"))
    bucket, own = Window.partitionBy("key"), Window.partitionBy("set_id")  # a set has no more keys than elements
    shared = bands.withColumns({"low": F.min("set_id").over(bucket), "high": F.max("set_id").over(bucket), "count": F.count("*").over(bucket)}).where("low < high")
    members = staged(shared.select("set_id", "key", "count").withColumn("met", F.sum("count").over(own)), "buckets")
    sets = wanted_sets(docs, text, width, bit_set(members.select("set_id").distinct(), "set_id"))
    sets = staged(sets.join(members.select("set_id").distinct(), "set_id", "left_semi").groupBy("set_id").agg(F.first("elements").alias("elements")), "elements")
    centres = members.groupBy("key").agg(F.max(F.struct("met", "set_id")).alias("centre")).select("key", F.col("centre.set_id").alias("centre"))
    stars = members.join(centres, "key").where("set_id <> centre").select(F.least("centre", "set_id").alias("a"), F.greatest("centre", "set_id").alias("b")).distinct()
    links = staged(verified(bounded(stars, nodes, threshold), sets, threshold), "star_links")
    first = components(links)
    labelled = nodes.join(first.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "n", "sketch", "lows", F.coalesce("component", "set_id").alias("component"))
    placed = members.drop("met").join(labelled, "set_id")
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    slices = F.ceil(F.col("count") / SLICE).cast("int")
    part = F.pmod(F.col("set_id"), F.col("slices")).cast("int")
    spread = (
        placed.join(open_keys, "key", "left_semi")
        .withColumn("slices", slices)
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "set_id", "n", "sketch", "lows", "component")
    )
    more = staged(verified(_across(spread, threshold), sets, threshold), "more_links")
    every = components(links.union(more))
    classes = nodes.join(every.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "least", F.coalesce("component", "set_id").alias("component"))
    named = classes.join(classes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("set_id", "component", "component_id")
    nothing = F.lit(None).cast("long")
    empty = rows.where("set_id IS NULL").select("doc_id", "n_shingles", "set_id", nothing.alias("component"), F.col("doc_id").alias("component_id"))
    return known.join(named, "set_id").select("doc_id", "n_shingles", "set_id", "component", "component_id").union(empty)


def jaccard_components(docs: DataFrame, text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every document."""
    return jaccard_classes(docs, text, width, threshold).select("doc_id", "n_shingles", "component_id")


def one_per_class(docs: DataFrame, text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """The documents, one of each class: the row of the smallest doc_id (null last), of one set and once if repeated.

    Documents without words are no copies of each other and stay. Rows whose id is surely not among the ids with a row
    to drop pass without a shuffle; the others are told apart by id and set.
    """
    classes = staged(jaccard_classes(docs, text, width, threshold), "classes").where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "set_id")).alias("first")
    firsts = classes.groupBy("component").agg(first, F.count("*").alias("n"))
    kept = firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.set_id").alias("_set"))
    touched = classes.join(firsts.where("n > 1").select("component"), "component", "left_semi").select(F.xxhash64("doc_id").alias("mark")).distinct()
    marks = bit_set(touched, "mark")
    flagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), held(F.xxhash64("doc_id"), marks).alias("held"))
    plain = flagged.where(~F.col("held")).select("doc.*")
    inner = flagged.where("held").select("doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            ids = [fingerprint(e) if len(e) else None for _, sets in _sets(texts(batch.column(0).field(text)), width) for e in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.int64())], names=["doc", "set_id"])

    told = staged(inner.mapInArrow(run, f"doc {inner.schema['doc'].dataType.simpleString()}, set_id long"), "told_apart")
    same = (told["set_id"] == kept["_set"]) & told["doc"].getField("doc_id").eqNullSafe(kept["_id"])
    chosen = told.join(kept, same, "left_semi").withColumn("id", F.col("doc").getField("doc_id")).dropDuplicates(["id", "set_id"]).select("doc.*")
    return plain.union(chosen).union(told.where("set_id IS NULL").select("doc.*"))
