"""Line and table sources, bounded and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import DOCUMENTS_TABLE

# A micro-batch takes about this much input for each task slot, so its size follows the
# cluster's. A file is never split between batches.
SLOT_BYTES = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """Give every task slot a share of an input that has fewer splits than slots.

    For work that grows rows, such as splitting texts. Large inputs have more splits
    than slots and stay as they are, without a shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``line`` per line of the files at any Hadoop-readable path."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def text_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The lines of a folder as a stream; new files are picked up as they land."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(path)
        .withColumnRenamed("value", "line")
    )


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. The source cannot replay after a failure."""
    return (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .load()
        .withColumnRenamed("value", "line")
    )


def documents(spark: SparkSession, data_dir: str, stream: bool = False) -> DataFrame:
    """``doc_id, text`` of the ``documents`` table, whole or as a stream of its files."""
    if stream:
        table = table_stream(spark, f"{data_dir}/document[s].parquet", DOCUMENTS_TABLE)
        return table.select("doc_id", "text")
    table = spark.read.schema(DOCUMENTS_TABLE).parquet(f"{data_dir}/documents.parquet")
    return spread(table.select("doc_id", "text"))


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files read as a stream, oldest first, in bounded micro-batches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is None:
        bytes_per_batch = bytes_per_batch or SLOT_BYTES * spark.sparkContext.defaultParallelism
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
