"""Running totals on streams: one row out for every row in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import without_end
from tidemark.plans import ordered
from tidemark.session import delete_at_end, scratch_dir
from tidemark.sinks.streams import BATCH_ID, run_batches

CARRIED = "_carried"


def running_totals(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    count: str,
    path: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    max_rows: int = ordered.MAX_ROWS,
) -> DataFrame:
    """All rows with ``count``: how often their key came up to and including them.

    Rows are counted in order within a micro-batch, as the table form does, in chunks
    behind the key's total of the micro-batches before. Totals are
    one row per key and are written anew by each micro-batch beside its rows, so a
    batch that is repeated, or a query that goes on from its checkpoint, counts alike.
    Null keys count as one key.
    """
    spark = stream.sparkSession
    if path is None:
        path = scratch_dir(spark, "running")
        delete_at_end(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        carried = None
        if batch_id:
            carried = spark.read.parquet(f"{path}/totals/{BATCH_ID}={batch_id - 1}")
        chunks, _ = ordered.in_chunks(batch, keys, order, max_rows)
        counts = ordered.chunk_counts(chunks, keys)
        totals = counts.select(*keys, F.col(ordered.WEIGHT).alias(CARRIED))
        if ordered.are_small(counts, max_rows):
            before = None if carried is None else carried.withColumnRenamed(CARRIED, ordered.WEIGHT)
            rows = ordered.count_along(chunks, keys, order, counts, count, before)
        else:
            rows = ordered.running_totals(batch, keys, order, {count: None}, max_rows)
            rows = rows if carried is None else _after(rows, carried, keys, count)
        if carried is not None:
            totals = totals.unionByName(carried)
        totals = totals.groupBy(*keys).agg(F.sum(CARRIED).alias(CARRIED))
        rows.write.mode("overwrite").parquet(f"{path}/rows/{BATCH_ID}={batch_id}")
        totals.write.mode("overwrite").parquet(f"{path}/totals/{BATCH_ID}={batch_id}")
        if batch_id > 1:  # a repeated batch needs the totals before its own only
            _drop(spark, f"{path}/totals/{BATCH_ID}={batch_id - 2}")

    run_batches(without_end(stream), write, checkpoint, drain)
    return spark.read.parquet(f"{path}/rows").drop(BATCH_ID)


def _after(rows: DataFrame, carried: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """The rows, counted on from the totals of the micro-batches before."""
    before = carried.select(*(F.col(k).alias(f"_k_{k}") for k in keys), CARRIED)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    rows = rows.join(before, same, "left").withColumn(count, F.col(count) + F.coalesce(CARRIED, F.lit(0)))
    return rows.drop(CARRIED, *(f"_k_{k}" for k in keys))


def _drop(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
