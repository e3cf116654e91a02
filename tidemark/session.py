"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors see.

    Only a local master may do without the setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "tidemark-checkpoints")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point the context at the checkpoint root unless it already has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once below the checkpoint root and read back.

    Cuts the lineage: what reads them sees the same rows, and a lost executor costs a
    read. The folder goes when the application ends.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
