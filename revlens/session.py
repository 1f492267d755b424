"""Session settings and the shared folder for checkpoints and cut-off tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Keys that a stream remembers stay on disk, in memory of a fixed size; a batch uploads what it changed.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


_local_folders: dict[str, str] = {}


def build_session(app_name: str = "revlens", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings. On a cluster leave `master` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local-mode session, where all tasks share one machine, falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if _local_folders.get(spark.sparkContext.applicationId):
        return _local_folders[spark.sparkContext.applicationId]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _local_folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="revlens-")
    return _local_folders[spark.sparkContext.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/revlens/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back: a lost executor repeats no work before it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
