"""Mixing of sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled by a keyed hash and laid end to end; the line is cut into blocks of equal words.
Slot k of the mix maps a golden-ratio point through the cumulative target shares to a source; a source's r-th slot
takes its block r, beginning again after the last, at most twice. Because the points are spread evenly, every stretch
of the mix, not only the whole, holds the sources at their shares.

Null text has size 0, null source is a source of its own, sorted last. Rows that agree in id, size and source are
interchangeable. An empty table gives an empty mix. Only functions of Spark run here, and no random numbers: runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import WORD, staged

BLOCK = 32
CHUNKS = 1024
WEIGHTS = (3, 1, 2)
SHARE, REPEATS = 1.5, 2

# the golden ratio's fraction of 2 to the 32; its multiples, taken modulo that, fill the range evenly
GOLDEN = 2654435769


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b.cast("long"))


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size in words, and the document's place in the shuffle: chunk and hash."""
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    chunk = F.conv(F.substring(mark, 1, 4), 16, 10).cast("int") % CHUNKS
    return docs.select("doc_id", "source", words.alias("size"), mark.alias("mark"), chunk.alias("chunk"))


def targets(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: source_size, target, and its range (low, high) of the cumulative shares in 32-bit points.

    Weights go round the sources in code point order. A target stops at `repeats` times the source; what is over goes
    to the others by weight until none is above. Sources in order of size for weight stop first, so that the level at
    which the rest is filled follows from running sums.
    """
    found = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (number % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * repeats).cast("double")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy("_stop", "_number")
    before, on = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (
        found.withColumns({"_number": number, "_weight": weight, "_cap": cap})
        .withColumns({"_stop": F.col("_cap") / F.col("_weight"), "_goal": F.sum("source_size").over(everything) * share})
        .withColumn("_level", (F.col("_goal") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(on))
        .withColumn("_level", F.max(F.when(F.col("_stop") >= F.col("_level"), F.col("_level"))).over(everything))
    )
    target = F.least("_cap", F.coalesce(F.col("_weight") * F.col("_level"), F.col("_cap")))
    in_order = Window.orderBy("_number")
    full = float(1 << 32)
    total = F.greatest(F.sum("target").over(everything), F.lit(1e-300))
    upto = F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        levels.withColumn("target", target)
        .withColumns({"high": F.round(upto / total * full).cast("long")})
        .withColumn("low", F.coalesce(F.lag("high").over(in_order), F.lit(0).cast("long")))
        .select("source", "source_size", "target", "low", "high")
    )


def slots(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: slot, source, and rank, the number of earlier slots of that source.

    The number of slots is the driver's one number. Slots are ranked within runs of 65,536 slots, and runs by the
    counts before them, so that a source that fills a third of the mix is ranked by many tasks. A slot finds its
    source among those whose range meets the same 1/256 of the axis.
    """
    wanted = goals.agg(F.round(F.sum("target") / block).cast("long")).first()[0] or 0
    point = F.pmod(F.col("slot"), F.lit(1 << 31)) * GOLDEN % (1 << 32)
    drawn = goals.sparkSession.range(wanted).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", 24))
    cells = F.explode(F.sequence(F.shiftright("low", 24), F.shiftright(F.col("high") - 1, 24)))
    ranges = goals.where("high > low").select("source", "low", "high", cells.alias("cell"))
    placed = drawn.join(ranges, "cell").where("point >= low AND point < high").select("slot", "source", F.shiftright("slot", 16).alias("run"))
    counted = placed.groupBy("source", "run").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(F.col("source").alias("_source"), F.col("run").alias("_run"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1
    within = placed.withColumn("_inner", inner)
    return within.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("run") == F.col("_run"))).select("slot", "source", (F.col("_before") + F.col("_inner")).alias("rank"))


def spans(slim: DataFrame) -> DataFrame:
    """Every document's stretch (begin, begin + size) of its source's shuffled line."""
    chunks = slim.groupBy("source", "chunk").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "chunk").orderBy("mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk")))
    return joined.select("doc_id", "source", "size", (F.col("_before") + F.col("_inside")).alias("begin"))


def mix(docs: DataFrame, text: str = "text", block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (the document's words in the mix, repeats counted).

    Blocks that the schedule takes are joined to the documents on them. Other columns are not carried.
    """
    slim = staged(sizes(docs, text), "mix_sizes")
    goals = staged(targets(slim, weights, share, repeats), "mix_targets")
    blocks = goals.select(F.col("source").alias("_source"), "source_size", F.ceil(F.col("source_size") / block).alias("_blocks"))
    taken = (
        slots(goals, block)
        .join(blocks, F.col("source").eqNullSafe(F.col("_source")))
        .where(F.col("rank") < F.col("_blocks") * repeats)
        .groupBy(F.col("source").alias("_source"), (F.col("rank") % F.col("_blocks")).alias("_block"))
        .agg(F.count("*").alias("_times"))
    )
    placed = staged(spans(slim).withColumn("_row", F.monotonically_increasing_id()), "mix_spans")
    last = F.col("begin") + F.col("size") - 1
    on_blocks = placed.where("size > 0").withColumn("_at", F.explode(F.sequence(_div(F.col("begin"), F.lit(block)), _div(last, F.lit(block)))))
    shared = F.least(last + 1, (F.col("_at") + 1) * block) - F.greatest(F.col("begin"), F.col("_at") * block)
    words = on_blocks.join(taken, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_block"))).groupBy("_row").agg(F.sum(shared * F.col("_times")).alias("taken"))
    with_taken = placed.join(words, "_row", "left").select("doc_id", "source", "size", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    facts = goals.select(F.col("source").alias("_source"), "source_size", "target")
    return with_taken.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows of the mix as documents: each as often as its words were taken, rounded to whole copies.

    Rows meet by doc_id, null with null; of rows that share an id, each is repeated as their mean says.
    """
    copies = taken.groupBy(F.col("doc_id").alias("id")).agg(F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int").alias("copies")).where("copies > 0")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    met = rows.join(copies, F.col("doc").getField("doc_id").eqNullSafe(F.col("id")))
    return met.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
