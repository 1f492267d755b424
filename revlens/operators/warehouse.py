"""The two-table warehouse: banks 1-n reviews, its keys, checks and loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.functions.lists import list_to_json
from revlens.operators.joins import spread_join
from revlens.session import stage

def in_order(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number all rows 1, 2, ... by `order`, in parallel and at any size.

    Rows are cut into ranges by a sample of the order and sorted inside them; a row's number is its place in its range
    plus the sizes of the ranges before. The sorted rows are written once, so that the ranges counted are those numbered.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = stage(placed, "in-order").withColumn("_range", F.shiftright("_at", 33))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    # one row per range, of which there are as many as tasks in the stage that wrote them
    numbered = rows.join(F.broadcast(shifts), "_range")
    return numbered.withColumn(out, F.col("_shift") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_range", "_shift")


def dense_ids(df: DataFrame, key: str, start: int | Column = 0, out: str = "id") -> DataFrame:
    """Number distinct keys start+1, start+2, ... in the order of (first two md5 digits, key); rows without a key are left out."""
    hashed = df.where(F.col(key).isNotNull()).withColumn("_bucket", F.substring(F.md5(key), 1, 2))
    start = start if isinstance(start, Column) else F.lit(start)
    numbered = in_order(hashed, ["_bucket", key], "_place")
    return numbered.withColumn(out, (start + F.col("_place")).cast("long")).drop("_bucket", "_place")


def upsert_banks(banks: DataFrame, names: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """The dimension with the names it lacked appended under new ids. `names(name)` may repeat."""
    new = names.select("name").where("name is not null").distinct().join(banks.select("name"), "name", "left_anti")
    top = banks.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    added = dense_ids(new, "name", top).withColumn("created_at", stamp)
    return banks.unionByName(added.select(banks.columns))


def review_key(*parts: Column | str) -> Column:
    """A stable id from the natural key; NULL and empty parts stay apart."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(p) if isinstance(p, str) else p), F.lit("?")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *marked), 256)


def typed_facts(scored: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Scored reviews in the column types of the fact table; what does not fit becomes NULL."""
    return scored.select(
        review_key("bank", "review_text", F.col("date").cast("string"), F.col("rating").cast("string")).alias("id"),
        "bank",
        "review_text",
        F.col("rating").cast("string").try_cast("decimal(2,1)").alias("rating"),
        F.col("date").cast("string").try_cast("date").alias("review_date"),
        "source",
        "cleaned_text",
        "sentiment_label",
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        list_to_json("keywords").alias("keywords"),
        list_to_json("themes").alias("themes"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("created_at"),
    )


def with_bank_ids(rows: DataFrame, banks: DataFrame, row_id: str = "id") -> DataFrame:
    """Replace the bank name by its id; rows of unknown banks are left out."""
    ids = banks.select(F.col("id").alias("bank_id"), F.col("name").alias("bank"))
    return spread_join(rows, ids, ["bank"], spread_on=row_id).drop("bank")


def unknown_banks(rows: DataFrame, banks: DataFrame, row_id: str = "id") -> DataFrame:
    """The rows that `with_bank_ids` leaves out, missing bank names included."""
    return spread_join(rows, banks.select(F.col("name").alias("bank")), ["bank"], "left_anti", spread_on=row_id)


def known_banks(rows: DataFrame, banks: DataFrame, row_id: str = "id") -> DataFrame:
    return spread_join(rows, banks.select(F.col("name").alias("bank")), ["bank"], "left_semi", spread_on=row_id)


def new_facts(facts: DataFrame, stored: DataFrame, newest: str | None = "created_at") -> DataFrame:
    """The facts a load still has to append: a second run of the same load appends nothing.

    Of several versions of an id in one load the newest by the named column counts, ties to the smallest row. Only facts
    whose id may repeat, by its hash, are moved and ordered; where ids are unique only hashes move.
    """
    order = [F.desc(newest)] if newest in facts.columns else []
    first = F.row_number().over(Window.partitionBy("id").orderBy(*order, *[F.col(c) for c in facts.columns if c != "id"]))
    mark = F.xxhash64("id").alias("_mark")
    repeated = stage(facts.select(mark).groupBy("_mark").agg(F.count("*").alias("_n")).where("_n > 1").select("_mark"), "repeated-ids")
    marked = facts.withColumn("_mark", mark)
    several = marked.join(repeated, "_mark", "left_semi").withColumn("_n", first).where("_n = 1")
    one = marked.join(repeated, "_mark", "left_anti").select(facts.columns).unionByName(several.select(facts.columns))
    return one.join(stored.select("id"), "id", "left_anti")


def report_extract(reviews: DataFrame, banks: DataFrame) -> DataFrame:
    """Scored reviews with their bank's name, as the reports read them."""
    scored = reviews.where(
        F.nullif(F.col("sentiment_label"), F.lit("")).isNotNull() & F.nullif(F.col("themes"), F.lit("")).isNotNull()
    )
    names = banks.select(F.col("id").alias("bank_id"), F.col("name").alias("bank_name"))
    return spread_join(scored, names, ["bank_id"], spread_on="id").select(
        "bank_name", "review_text", "rating", "review_date", "sentiment_label", "keywords", "themes"
    )


def without_banks(reviews: DataFrame, banks: DataFrame, deleted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables after deleting banks by `name`, the deleted banks' reviews included."""
    gone = banks.join(deleted.select("name"), "name", "left_semi").select(F.col("id").alias("bank_id"))
    kept_banks = banks.join(deleted.select("name"), "name", "left_anti").select(banks.columns)
    kept = spread_join(reviews, gone, ["bank_id"], "left_anti", spread_on="id").select(reviews.columns)
    return kept_banks, kept


def audit_unique(df: DataFrame, column: str, rule: str) -> DataFrame:
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key"), "n")


def audit_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per column that holds NULLs, all columns checked in one pass."""
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(f"{table}.{c} not null").alias("rule"), F.lit(c).alias("key"), F.count(F.when(F.col(c).isNull(), 1)).alias("n"))
                for c in columns
            ]
        ).alias("r")
    )
    return counts.select(F.explode("r").alias("r")).select("r.*").where("n > 0")


def audit_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Child keys without a parent and how many rows carry each; keys are counted before the join."""
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    orphans = used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
    return orphans.select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key"), "n")


def audit_warehouse(banks: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every broken constraint as `(rule, key, n)`; an empty result means a sound warehouse."""
    checks = [
        audit_unique(banks, "id", "banks.id primary key"),
        audit_unique(banks, "name", "banks.name unique"),
        audit_not_null(banks, ["id", "name"], "banks"),
        audit_unique(reviews, "id", "reviews.id primary key"),
        audit_not_null(reviews, ["id", "bank_id", "review_text"], "reviews"),
        audit_foreign_key(reviews, "bank_id", banks, "id", "reviews.bank_id foreign key"),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
