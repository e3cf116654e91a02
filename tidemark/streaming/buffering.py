"""Buffers of a shard filled by many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import without_end
from tidemark.plans import ordered
from tidemark.session import delete_at_end, scratch_dir
from tidemark.sinks.streams import BATCH_ID, run_batches

FULL, NEW, NUMBER = "_full", "_new", "_number"


def dealt_chunks(
    stream: DataFrame,
    shard: str = "shard",
    order: Sequence[str] = ("event_id",),
    size: int = 10,
    path: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    max_rows: int = ordered.MAX_ROWS,
) -> DataFrame:
    """The rows of each full buffer of ``size``, with ``chunk``, as :func:`full_chunks` has
    them, for shards that no task could number alone.

    A micro-batch's rows are numbered behind the rows held from before; a large shard is
    cut in chunks whose counts add up, so its rows lie in many tasks. What no buffer
    takes, fewer than ``size`` rows a shard, is held for the next micro-batch, with the
    number of buffers filled. Both are written beside the output, so a batch that is
    repeated, or a query that goes on from its checkpoint, fills the same buffers. A
    null shard is a shard.
    """
    spark = stream.sparkSession
    if path is None:
        path = scratch_dir(spark, "dealt-chunks")
        delete_at_end(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(NEW, F.lit(1))
        done = None
        if batch_id:
            last = f"{path}/rows/{BATCH_ID}={batch_id - 1}"
            held = spark.read.schema(batch.schema).parquet(f"{last}/{FULL}=false")
            rows = rows.unionByName(held.withColumn(NEW, F.lit(0)))
            done = spark.read.parquet(f"{path}/done/{BATCH_ID}={batch_id - 1}")
        rows.persist()
        try:
            counts = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("_total"))
            if done is None:
                counts = counts.withColumn("_done", F.lit(0).cast("bigint"))
            else:
                counts = counts.unionByName(done, allowMissingColumns=True).groupBy(shard).agg(
                    F.coalesce(F.sum("_total"), F.lit(0)).alias("_total"), F.coalesce(F.sum("_done"), F.lit(0)).alias("_done")
                )
            filled = F.call_function("div", F.col("_total"), F.lit(size).cast("bigint"))
            numbered = ordered.running_totals(rows, [shard], [NEW, *order], {NUMBER: None}, max_rows)
            of_shard = counts.select(F.col(shard).alias("_shard"), "_done", filled.alias("_filled"))
            numbered = numbered.join(of_shard, F.col(shard).eqNullSafe(F.col("_shard")))
            buffer = F.call_function("div", F.col(NUMBER) - 1, F.lit(size).cast("bigint"))
            out = numbered.select(
                *batch.columns, (F.col("_done") + buffer).alias("chunk"), (buffer < F.col("_filled")).alias(FULL)
            )
            out.write.mode("overwrite").partitionBy(FULL).parquet(f"{path}/rows/{BATCH_ID}={batch_id}")
            for full in ("true", "false"):  # a folder for each, also without rows
                _make(spark, f"{path}/rows/{BATCH_ID}={batch_id}/{FULL}={full}")
            counts.select(shard, (F.col("_done") + filled).alias("_done")).write.mode("overwrite").parquet(
                f"{path}/done/{BATCH_ID}={batch_id}"
            )
        finally:
            rows.unpersist()

    stream = without_end(stream)
    run_batches(stream, write, checkpoint, drain)
    schema = T.StructType(
        [
            *stream.schema.fields,
            T.StructField("chunk", T.LongType()),
            T.StructField(BATCH_ID, T.IntegerType()),
            T.StructField(FULL, T.BooleanType()),
        ]
    )
    return spark.read.schema(schema).parquet(f"{path}/rows").filter(FULL).drop(BATCH_ID, FULL)


def _make(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
