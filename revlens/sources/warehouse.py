"""Where the warehouse tables live: Parquet folders, or a database behind JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from revlens.operators.warehouse import new_facts, report_extract
from revlens.session import stage
from revlens.sources import ledger

MONTH, LOAD = "month", "load"

# Names of the tables and columns of the store.
REPORT_QUERY = """
    SELECT b.NAME AS bank_name, r.REVIEW_TEXT AS review_text, r.RATING AS rating, r.REVIEW_DATE AS review_date,
           r.SENTIMENT_LABEL AS sentiment_label, r.KEYWORDS AS keywords, r.THEMES AS themes, r.ID AS id
    FROM REVIEWS r JOIN BANKS b ON r.BANK_ID = b.ID
    WHERE r.SENTIMENT_LABEL IS NOT NULL AND r.THEMES IS NOT NULL
"""


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """Scored reviews with bank names from `folder/reviews` and `folder/banks`."""
    return report_extract(spark.read.parquet(f"{folder}/reviews"), spark.read.parquet(f"{folder}/banks"))


def jdbc_options(url: str, bounds: tuple[str, str], partitions: int, fetch_size: int = 10_000, **options: str) -> dict[str, str]:
    """Options for a parallel read of the report: the database joins and filters, ranges of the review date split the
    rows. Ids are text, which Spark does not split by. `bounds` are dates as text; they set the stride and drop no row."""
    return {
        "url": url,
        "dbtable": f"({REPORT_QUERY}) report",
        "partitionColumn": "review_date",
        "lowerBound": bounds[0],
        "upperBound": bounds[1],
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **options,
    }


def read_report_jdbc(spark: SparkSession, url: str, bounds: tuple[str, str], partitions: int, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, bounds, partitions, **options)).load().drop("id")


def write_facts_jdbc(facts: DataFrame, url: str, table: str = "REVIEWS", batch_size: int = 10_000, **options: str) -> None:
    """Append in batches, one connection per partition."""
    writer = facts.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=batch_size, **options)
    writer.save()


def load_name(facts: DataFrame) -> tuple[str, int]:
    """A name that a load has in every run, whatever its order and files, and its number of rows."""
    marks = [F.sum(F.xxhash64(*([F.lit(salt)] if salt else []), "id").cast("decimal(38,0)")) for salt in (0, 1)]
    n, *sums = facts.agg(F.count("*"), *marks).first()
    return f"{n:x}-" + "-".join(f"{int(s or 0) % (1 << 64):016x}" for s in sums), n


def read_facts(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The facts of all recorded loads; what a broken load left is not among them."""
    names = [row[0] for row in ledger.records(spark, path).where("n_rows > 0").select("name").distinct().collect()]  # one per load
    if not names:
        return spark.createDataFrame([], schema or "id string")
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*(f"{path}/{LOAD}={name}" for name in sorted(names))).drop(LOAD)


def append_facts(facts: DataFrame, path: str, date: str = "review_date") -> bool:
    """Append the facts that the stored table lacks, as a load of its own; whether it wrote anything.

    A load is named by its facts and recorded last. A load that was recorded is known by its name and meets no stored fact; one that broke
    off left no record, is not read, and is written anew in its place. Only a new load is compared with stored facts: with a date,
    which is part of a fact's id, those of the months it touches in the loads that touched them; without one, all.
    """
    spark = facts.sparkSession
    dated = date in facts.columns
    if dated:
        facts = facts.withColumn(MONTH, F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none")))
    facts = stage(facts, "load")
    name, n = load_name(facts)
    known = ledger.records(spark, path)
    if n == 0 or not known.where(F.col("name") == name).isEmpty():
        return False
    months = [row[0] for row in facts.select(MONTH).distinct().collect()] if dated else []  # a load's months
    met = known.where("n_rows > 0")
    if dated:
        met = met.where(F.arrays_overlap("parts", F.lit(months)))
    loads = sorted({row[0] for row in met.select("name").collect()})
    new = facts
    if loads:
        stored = spark.read.schema(facts.schema).option("basePath", path).parquet(*(f"{path}/{LOAD}={one}" for one in loads))
        new = new_facts(facts, stored.where(F.col(MONTH).isin(months)) if dated else stored)
    else:
        new = new_facts(facts, facts.limit(0))
    folder = f"{path}/{LOAD}={name}"
    new.write.mode("overwrite").partitionBy(*([MONTH] if dated else [])).parquet(folder)
    written = spark.read.schema(facts.schema).parquet(folder).count()
    ledger.record(spark, path, name, written, months)
    return written > 0


def list_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Every table and view of a database with its columns and types."""
    rows = [
        (table.name, table.tableType, column.name, column.dataType)
        for table in spark.catalog.listTables(database)
        for column in spark.catalog.listColumns(table.name if table.isTemporary else f"{table.catalog}.{'.'.join(table.namespace)}.{table.name}")
    ]
    schema = "table_name string, table_type string, column_name string, data_type string"
    return spark.createDataFrame(rows, schema).orderBy("table_name", F.col("column_name"))
