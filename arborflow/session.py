"""Session settings the jobs are designed for, and shared-storage tables that cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # one source file fans out to many rows, so a parse task should start from little input
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # a graph build compiles more stages than the default cache of 100 holds
    "spark.sql.codegen.cache.maxEntries": "2000",
}

#: Partitions that large shuffles start from.
FINE_PARTITIONS = 1000

_local_root: dict[str, str] = {}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that jobs may start from any folder.

    Whatever runs Python on the executors calls this first; `keep` does so too. The modules
    travel compiled, since a worker would compile them anew each time it imports from the zip.
    """
    if getattr(spark.sparkContext, "_arborflow_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="arborflow-")
    path = os.path.join(folder, "arborflow.zip")
    copy = shutil.copytree(home, os.path.join(folder, "arborflow"), ignore=shutil.ignore_patterns("__pycache__"))
    with zipfile.PyZipFile(path, "w") as out:
        out.writepy(copy)
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._arborflow_shipped = True


def split_finely(spark: SparkSession) -> None:
    """Let shuffles start from FINE_PARTITIONS partitions at least, which adaptive execution merges up to its advised size.

    What one task sorts then follows that size and not the input. Jobs whose joins sort whole tables call this first.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(now) < FINE_PARTITIONS:
        spark.conf.set(key, str(FINE_PARTITIONS))


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="arborflow-")
    return _local_root[app]


def keep(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write once to shared storage and read back.

    The copy is columnar, so each reader loads only its columns; it survives executor
    loss, and plans built on it start from a scan instead of the whole lineage.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{work_root(spark)}/arborflow/{uuid.uuid4().hex}/{name}"
    df.write.mode("errorifexists").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def keep_dealt(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """Like `keep`, but the copy is dealt by `key` into so many buckets, which its readers know of.

    Tables dealt alike are joined, grouped and windowed by keys that include `key` without a shuffle, and rows that
    are dealt already are written one file a bucket. Of the catalog only the bucketed write and read make use: the
    entry goes again, the files stay like those of `keep`.
    """
    spark = df.sparkSession
    ship(spark)
    # a join by (key, more) may use the dealing by key alone; skew is bounded by what one key holds
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    run = uuid.uuid4().hex
    table = f"arborflow_{name}_{run}"
    path = f"{work_root(spark)}/arborflow/{run}/{name}"
    df.write.format("parquet").bucketBy(parts, key).options(path=path, compression="zstd").saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # external, so its files stay
    return stored
