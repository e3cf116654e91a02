"""Output in full buffers of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordered import MAX_ROWS, running_totals


def _chunk_numbers(
    df: DataFrame, shard: str, order: Sequence[str], size: int, max_rows: int
) -> DataFrame:
    """Add ``chunk`` and ``place``, the row's place in its chunk from 0."""
    numbered = running_totals(df, [shard], order, {"_rn": None}, max_rows)
    return numbered.select(
        *df.columns,
        F.expr(f"(_rn - 1) div {int(size)}").alias("chunk"),
        ((F.col("_rn") - 1) % size).alias("place"),
    )


def chunk_summaries(
    df: DataFrame,
    shard: str = "shard",
    order: Sequence[str] = ("event_id",),
    size: int = 10,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``shard, chunk, n, first_id, last_id`` of every buffer that filled up.

    Ids are those of the last order column.
    """
    row_id = F.col(order[-1])
    chunks = _chunk_numbers(df, shard, order, size, max_rows).groupBy(shard, "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("place") == 0, row_id)).alias("first_id"),
        F.max(F.when(F.col("place") == size - 1, row_id)).alias("last_id"),
    )
    return chunks.filter(F.col("n") == size)


def full_chunks(
    df: DataFrame,
    shard: str = "shard",
    order: Sequence[str] = ("event_id",),
    size: int = 10,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """The rows of all full buffers with their ``chunk``; the rest stays held back."""
    numbered = _chunk_numbers(df, shard, order, size, max_rows)
    filled = F.count(F.lit(1)).over(Window.partitionBy(shard, "chunk"))
    return numbered.withColumn("_filled", filled).filter(F.col("_filled") == size).drop(
        "_filled", "place"
    )
