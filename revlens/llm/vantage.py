"""Approximate nearest neighbours by vantage-point trees.

Vectors are scaled to length one, where Euclidean distance orders as cosine does and obeys the triangle inequality.
Every shard is one tree: a node's vantage point splits its vectors at the median distance, leaves hold `LEAF` vectors.
A search walks the near side first and skips the far side if no vector there can be nearer than the k-th found; the
triangle inequality makes that certain. `factor` below one shrinks the margin, so that more is skipped and the result
is approximate; factor one restores exact search. Queries come in blocks and meet every shard.

Equal vectors are searched once: only the k + 1 smallest ids of equal vectors can be among k nearest. Vectors that
are null, empty, zero, hold nulls or numbers that are not finite take no part, nor do those with a null id. Vectors of
another length than a query's are no candidates. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import staged

SHARD = 8192
LEAF = 64
BLOCK = 8192
FACTOR = 0.6


class Tree:
    """A vantage-point tree over rows of `points`, as flat arrays; rows of a leaf lie together in `order`."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, labels: np.ndarray | None = None):
        self.points, self.leaf = points, leaf
        self.labels = np.append(np.arange(len(points)) if labels is None else labels, np.iinfo(np.int64).max)  # the last one is of no row
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, float, int, int]] = []
        self.root = self._build(0, len(points))

    def _build(self, start: int, stop: int) -> int:
        """Node: (start, stop, vantage row or -1, radius, inner child, outer child)."""
        rows = self.order[start:stop]
        number = len(self.nodes)
        self.nodes.append((start, stop, -1, 0.0, -1, -1))
        if len(rows) <= self.leaf:
            return number
        centre = self.points[rows].mean(axis=0)
        far = rows[int(np.argmax(((self.points[rows] - centre) ** 2).sum(axis=1)))]
        distance = np.sqrt(((self.points[rows] - self.points[far]) ** 2).sum(axis=1))
        half = len(rows) // 2
        split = np.argpartition(distance, half)
        self.order[start:stop] = rows[split]
        radius = float(distance[split[half]])
        self.nodes[number] = (start, stop, int(far), radius, self._build(start, start + half), self._build(start + half, stop))
        return number

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest rows of each query and their squared distances, nearest first, ties (to 12 places) to the smaller label; missing ones have row -1."""
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1)

        def visit(node: int, who: np.ndarray) -> None:
            start, stop, vantage, radius, inner, outer = self.nodes[node]
            if vantage < 0:
                inside = self.order[start:stop]
                square = np.round(np.maximum(2 - 2 * queries[who] @ self.points[inside].T, 0), 12)
                distance = np.concatenate([best[who], square], axis=1)
                names = np.concatenate([rows[who], np.broadcast_to(inside, (len(who), len(inside)))], axis=1)
                first = np.lexsort((self.labels[names], distance), axis=1)[:, :k]
                best[who] = np.take_along_axis(distance, first, axis=1)
                rows[who] = np.take_along_axis(names, first, axis=1)
                return
            gap = np.sqrt(((queries[who] - self.points[vantage]) ** 2).sum(axis=1)) - radius
            for side, near, far in ((gap < 0, inner, outer), (gap >= 0, outer, inner)):
                group, margin = who[side], np.abs(gap[side])
                if len(group):
                    visit(near, group)
                    # the slack covers rounding in distances taken from dot products
                    left = group[margin * factor_inverse <= np.sqrt(best[group, -1]) + 2e-6]
                    if len(left):
                        visit(far, left)

        factor_inverse = 1 / factor
        if len(queries) and len(self.points):
            visit(self.root, np.arange(len(queries)))
        return rows, best


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and the vector in double precision, of the rows that take part."""
    wide = F.col(vector).cast("array<double>").alias("vector")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("vector", lambda x: x != 0)
    return vectors.select("vec_id", wide).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(good)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the k nearest found of every query.

    `queries` are rows (vec_id, vector) too; a query's own id is no candidate.
    """
    points, asked = usable(vectors, vector), usable(queries, vector)
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = points.distinct().withColumn("_r", smallest).where(F.col("_r") <= k + 1)
    # of equal vectors at most k + 1 ids come together
    groups = staged(distinct.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("mark", F.xxhash64("vector")), "vectors")
    total = groups.count()
    shards = max(1, -(-total // shard))
    asked = staged(asked.distinct(), "query_vectors")
    blocks = max(1, -(-asked.count() // BLOCK))
    each_block, each_shard = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    index = groups.select(F.pmod("mark", F.lit(shards)).cast("int").alias("shard"), each_block.alias("block"), F.size("vector").alias("dims"), "ids", "vector")
    sought = asked.select(each_shard.alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.size("vector").alias("dims"), "vec_id", "vector")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            left = left.combine_chunks()
            right = right.combine_chunks()
            ids = left.column("ids").to_pylist()
            original = _matrix(left.column("vector").combine_chunks())
            wanted = _matrix(right.column("vector").combine_chunks())
            scaled = original / np.sqrt((original / np.abs(original).max(axis=1, keepdims=True)) ** 2 @ np.ones((original.shape[1], 1))) / np.abs(original).max(axis=1, keepdims=True)
            probes = wanted / np.sqrt((wanted / np.abs(wanted).max(axis=1, keepdims=True)) ** 2 @ np.ones((wanted.shape[1], 1))) / np.abs(wanted).max(axis=1, keepdims=True)
            rows, _ = Tree(scaled, labels=np.array([some[0] for some in ids], np.int64)).search(probes, min(k + 1, len(original)), factor)
            for name, probe, found in zip(right.column("vec_id").to_pylist(), wanted, rows, strict=True):
                found = found[found >= 0]
                near = original[found]
                score = (near * probe).sum(axis=1) / (np.sqrt((near * near).sum(axis=1)) * np.sqrt((probe * probe).sum()))
                hits = sorted((-float(s), v) for r, s in zip(found, score, strict=True) for v in ids[r] if v != name)
                out += [(name, v, -s) for s, v in hits[:k]]
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    keys = ["shard", "block", "dims"]
    found = index.groupBy(*keys).cogroup(sought.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
