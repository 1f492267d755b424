"""Shards along a Hilbert curve over several metadata dimensions.

Dimensions are quantised to `BITS` bits each, every row gets its index on the curve, rows are sorted by it and the
order is cut into runs of equal row counts. Rows of one shard are near in every dimension, so that files and their
minimum and maximum statistics can be skipped by a filter on any of them.

Text dimensions are quantised by the share of rows that sort before the value, so that a common value spans its share
of the axis; null sorts last. Numbers are quantised by their logarithm. Null text has size 1 and the checksum of no
bytes. Equal rows are interchangeable: whichever comes first, the shards hold the same rows. An empty table gives an
empty result. Only functions of Spark run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import staged

BITS = 5


def share_codes(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """One row per value of a column (null included) with its code: the quantised share of rows before it.

    Counts are combined before they move; the window sees one row per distinct value.
    """
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("value").asc_nulls_last())
    total = F.sum("n").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.select("value", F.floor(before * (1 << bits) / total).cast("int").alias("code"))


def log_code(number: Column, bits: int = BITS) -> Column:
    """The number's logarithm in steps of a half, from 0 to the highest code."""
    return F.least(F.floor(F.log2(F.greatest(number, F.lit(1))) * 2), F.lit((1 << bits) - 1)).cast("int")


def hilbert_index(codes: list[Column], bits: int = BITS) -> Column:
    """The place of a cell on the Hilbert curve through the cube of all codes.

    Coordinates are turned into the transposed index by undoing, from the highest bit down, the reflections and
    exchanges of axes of the curve, then Gray-coding; the bits are interleaved, the first axis highest.
    """
    n = len(codes)

    def undo(x: Column, bit: Column) -> Column:
        low = bit - 1

        def axis(state: Column, i: Column) -> Column:
            head, own = F.get(state, F.lit(0)), F.get(state, i)
            swap = (head.bitwiseXOR(own)).bitwiseAND(low)
            flipped = F.transform(state, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v))
            exchanged = F.transform(state, lambda v, k: F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v))
            return F.when(own.bitwiseAND(bit) != 0, flipped).otherwise(exchanged)

        return F.aggregate(F.array(*(F.lit(i) for i in range(n))), x, axis)

    bit_values = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1)))
    turned = F.aggregate(bit_values, F.array(*codes), undo)
    gray = F.aggregate(
        turned,
        F.array().cast("array<int>"),
        lambda done, v: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)).bitwiseXOR(v))),
    )
    spread = F.aggregate(bit_values, F.lit(0), lambda t, bit: F.when(F.get(gray, F.lit(n - 1)).bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t))
    all_bits = F.array(*(F.lit(b) for b in range(bits - 1, -1, -1)))
    return F.get(
        F.transform(
            F.array(F.struct(gray.alias("x"), spread.alias("t"))),
            lambda s: F.aggregate(
                all_bits,
                F.lit(0).cast("long"),
                lambda done, b: F.aggregate(s["x"], done, lambda d, v: d * 2 + F.call_function("getbit", v.bitwiseXOR(s["t"]), b).cast("long")),
            ),
        ),
        F.lit(0),
    )


def ranked(df: DataFrame, order: list[str], name: str, position: str = "position") -> DataFrame:
    """Number all rows from 0 by `order`, without gaps and in parallel.

    Rows are range-partitioned and sorted; the number of a row is its place in its partition plus the sizes of the
    partitions before. The sorted rows are staged once, so that the partitions counted are those numbered.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = staged(sorted_rows, name)
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    # one row per partition of the stage above: as small as the task list the driver holds anyway
    return rows.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(position, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")


def hilbert_shards(docs: DataFrame, shards: int, text: str = "text", dimensions: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id and the dimensions of every document, with size, text_crc32, curve, law, shard, slot and grown_shard.

    Row counts of two shards differ by one at most. Other columns, whatever their names, are not carried.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = {"size": F.octet_length(body).cast("long") + 1, "text_crc32": F.crc32(F.encode(body, "UTF-8")), "_tie": F.xxhash64(body)}
    slim = staged(docs.select("doc_id", *dimensions, text).withColumns(out).drop(text), "shard_keys")
    coded = slim
    for i, column in enumerate(dimensions):
        codes = share_codes(slim, column).toDF(f"_value{i}", f"_code{i}")
        coded = coded.join(codes, F.col(column).eqNullSafe(F.col(f"_value{i}"))).drop(f"_value{i}")
    axes = [*(F.col(f"_code{i}") for i in range(len(dimensions))), log_code(F.col("size"))]
    curve = coded.withColumn("curve", hilbert_index(axes)).drop(*(f"_code{i}" for i in range(len(dimensions))))
    numbered = ranked(curve, ["curve", "doc_id", "text_crc32", "_tie"], "sharded").drop("_tie")
    total = slim.agg(F.count("*")).first()[0]
    start = F.call_function("div", F.col("shard") * total + (shards - 1), F.lit(shards).cast("long"))
    return (
        numbered.withColumn("shard", F.call_function("div", F.col("position") * shards, F.lit(max(total, 1)).cast("long")).cast("int"))
        .withColumn("slot", F.col("position") - start.cast("long"))
        .withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})
        .drop("position")
    )
