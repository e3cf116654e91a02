"""Ordered per-key computations that survive a key holding most of the rows.

A window partitioned by key puts a whole key into one task. Here the keys with
more than about ``max_rows`` rows are found first. When there are some, their rows are
cut along the order columns into chunks of bounded size. Each chunk becomes a
window partition of its own and starts with one *carry* row, which holds what the
chunks before it add up to. Carries come from partial aggregates per chunk, so
rows travel once and nothing is joined back. Without a large key the plan is the
plain window.

The order columns may be of any type that Spark sorts, and together they should be
unique per key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import enable_checkpoints, written

# Rows one task may take from a single key.
MAX_ROWS = 2_000_000
# Sampled rows by which a key of that size is recognised.
ROWS_PER_KEY = 1000
# More large keys than this stay in a checkpointed table, off the driver.
MAX_LISTED_KEYS = 10_000

CHUNK = "_chunk"
LARGE = "_large"
REAL = "_real"
WEIGHT = "_weight"
# Equal steps of an order column, of which chunks are made up.
BINS = 4096
# Before all chunks; nulls of the order column are chunk -1.
FIRST_CHUNK = -2


@dataclass(frozen=True)
class Chunked:
    """Input rows, plus ``CHUNK`` and ``LARGE`` when ``split`` is set."""

    rows: DataFrame
    keys: list[str]
    split: bool

    @property
    def groups(self) -> list[str]:
        return [*self.keys, CHUNK] if self.split else self.keys

    def large_rows(self) -> DataFrame:
        return self.rows.filter(LARGE)

    def with_carry(self, carry: DataFrame) -> DataFrame:
        """Rows and carry rows together; carry rows have ``REAL`` = 0."""
        real = self.rows.withColumn(REAL, F.lit(1))
        return real.unionByName(carry.withColumn(REAL, F.lit(0)), allowMissingColumns=True)


def _large_keys(df: DataFrame, keys: list[str], max_rows: int) -> tuple[DataFrame | None, int]:
    """Keys with more than ``max_rows`` rows, and about how many rows they hold.

    Counting every key would shuffle nearly as much as the computation itself, so a
    share of the rows is counted in which such a key still has ``ROWS_PER_KEY``.
    """
    spark = SparkSession.active()
    share = min(1.0, ROWS_PER_KEY / max_rows)
    counted = df.select(*keys)
    counted = counted if share == 1.0 else counted.sample(share, seed=11)
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.filter(F.col("_n") > max_rows * share)
    found = counts.orderBy(F.desc("_n")).limit(MAX_LISTED_KEYS + 1).collect()
    if not found:
        return None, 0
    if len(found) <= MAX_LISTED_KEYS:
        table = spark.createDataFrame(found, counts.schema)
        n_rows = sum(row["_n"] for row in found) / share
        return F.broadcast(table.drop("_n")), math.ceil(n_rows)
    enable_checkpoints(spark)
    table = counts.checkpoint()
    return table.drop("_n"), math.ceil(table.agg(F.sum("_n")).first()[0] / share)


def _mark_large(df: DataFrame, keys: list[str], large: DataFrame) -> DataFrame:
    marks = large.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_hit"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    marked = df.join(marks, same, "left")
    return marked.withColumn(LARGE, F.col("_hit").isNotNull()).drop(
        "_hit", *[f"_k_{k}" for k in keys]
    )


def _cut(
    df: DataFrame, keys: list[str], order: Sequence[str], n_rows: int, max_rows: int
) -> DataFrame:
    """Set ``CHUNK``, rising with the order, on the rows marked ``LARGE``.

    Spark's range partitioning by keys and order makes the chunks, whatever the types
    and however often a value repeats. The numbered rows are written once, so all
    readers see the same cuts and the driver holds none of them.
    """
    pieces = max(2, math.ceil(2 * n_rows / max_rows))
    ranges = df.filter(LARGE).repartitionByRange(pieces, *keys, *order)
    cut = written(ranges.withColumn(CHUNK, F.spark_partition_id().cast("bigint")), "cut-rows")
    return df.filter(~F.col(LARGE)).withColumn(CHUNK, F.lit(0).cast("bigint")).unionByName(cut)


def chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS
) -> Chunked:
    """Cut the rows of large keys into ordered chunks.

    With no keys the table is one group; it is cut in any case, so that the
    work spreads over the cluster.
    """
    keys = list(keys)
    if keys:
        large, n_rows = _large_keys(df, keys, max_rows)
        if large is None:
            return Chunked(df, keys, split=False)
        marked = _mark_large(df, keys, large)
    else:
        n_rows = df.count()
        slots = SparkSession.active().sparkContext.defaultParallelism
        max_rows = min(max_rows, max(1, math.ceil(2 * n_rows / max(slots, 2))))
        marked = df.withColumn(LARGE, F.lit(True))
    return Chunked(_cut(marked, keys, order, n_rows, max_rows), keys, split=True)


def _tidy(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REAL) == 1).drop(REAL, CHUNK, LARGE)


def _before(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, str | None],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add running totals per key up to and including each row.

    ``totals`` maps a new column to the column it sums; ``None`` counts rows.
    """
    cut = chunked(df, keys, order, max_rows)
    upto = Window.unboundedPreceding, Window.currentRow
    if not cut.split:
        w = Window.partitionBy(*cut.keys).orderBy(*order).rowsBetween(*upto)
        return cut.rows.select(
            "*",
            *[
                (F.count(F.lit(1)) if c is None else F.sum(c)).over(w).alias(name)
                for name, c in totals.items()
            ],
        )
    weights = {name: f"_w_{name}" for name in totals}
    rows = cut.rows.select(
        "*",
        *[
            (F.lit(1).cast("bigint") if c is None else F.col(c)).alias(weights[name])
            for name, c in totals.items()
        ],
    )
    weighted = Chunked(rows, cut.keys, split=True)
    sums = weighted.large_rows().groupBy(*cut.groups).agg(
        *[F.sum(w).alias(w) for w in weights.values()]
    )
    carry = sums.select(
        *cut.groups, *[F.sum(w).over(_before(cut.keys)).alias(w) for w in weights.values()]
    ).filter(F.coalesce(*[F.col(w) for w in weights.values()]).isNotNull())
    w = Window.partitionBy(*cut.groups).orderBy(REAL, *order).rowsBetween(*upto)
    summed = weighted.with_carry(carry).select(
        "*", *[F.sum(weights[name]).over(w).alias(name) for name in totals]
    )
    return _tidy(summed).drop(*weights.values())


def in_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS
) -> tuple[DataFrame, int]:
    """All rows with ``CHUNK``, which rises with the first order column, and the number of
    chunks; so many that a key has at most about ``max_rows`` rows in one.

    A sample gives the largest key and how the order column spreads. The chunk follows
    from the row alone, so rows are neither joined nor written to be cut. An order
    column that is no whole number makes one chunk.
    """
    whole = isinstance(df.schema[order[0]].dataType, T.IntegralType)
    if not whole:
        return df.withColumn(CHUNK, F.lit(0)), 1
    share = min(1.0, ROWS_PER_KEY / max_rows)
    sampled = df.select(*keys, F.col(order[0]).cast("double").alias("_at"))
    sampled = (sampled if share == 1.0 else sampled.sample(share, seed=11)).persist()
    try:
        n_rows, low, high = sampled.agg(F.count(F.lit(1)), F.min("_at"), F.max("_at")).first()
        top = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if top <= max_rows * share or low is None:
            return df.withColumn(CHUNK, F.lit(0)), 1
        pieces = math.ceil(2 * top / (max_rows * share))
        width = max(1.0, (high - low) / BINS)

        def bin_of(at: Column) -> Column:
            """1 to ``BINS``; values beyond the sample's count to its ends."""
            return F.least(F.greatest((at - low) / width, F.lit(0.0)), F.lit(BINS - 1.0)).cast("int") + 1

        counts = dict(sampled.groupBy(bin_of(F.col("_at"))).count().collect())
    finally:
        sampled.unpersist()
    chunks, done = [], counts.pop(None, 0)
    for i in range(1, BINS + 1):
        chunks.append(min(pieces - 1, pieces * done // n_rows))
        done += counts.get(i, 0)
    chunk = F.element_at(F.lit(chunks), bin_of(F.col(order[0]).cast("double")))
    return df.withColumn(CHUNK, F.coalesce(chunk, F.lit(-1))), pieces


def chunk_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, CHUNK, WEIGHT``: the rows of each key in each chunk; written, as they are read again."""
    return written(rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias(WEIGHT)), "chunk-counts")


def are_small(counts: DataFrame, max_rows: int) -> bool:
    """Whether chunks came out about as small as asked; one value may hold too many rows."""
    return (counts.agg(F.max(WEIGHT)).first()[0] or 0) <= 4 * max_rows


def count_along(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counts: DataFrame,
    count: str,
    before: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key in order, chunk by chunk, behind a carry row that holds
    what the chunks before have of the key, and ``before`` (``keys, WEIGHT``) at first."""
    keys = list(keys)
    sums = counts
    if before is not None:
        sums = counts.unionByName(before.select(*keys, F.lit(FIRST_CHUNK).alias(CHUNK), WEIGHT))
    carry = sums.select(*keys, CHUNK, F.sum(WEIGHT).over(_before(keys)).alias(WEIGHT)).filter(
        F.col(WEIGHT).isNotNull() & (F.col(CHUNK) != FIRST_CHUNK)
    )
    line = rows.unionByName(carry, allowMissingColumns=True)  # only carry rows have a weight
    w = Window.partitionBy(*keys, CHUNK).orderBy(F.col(WEIGHT).asc_nulls_last(), *order)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = line.withColumn(count, F.sum(F.coalesce(WEIGHT, F.lit(1).cast("bigint"))).over(w))
    return numbered.filter(F.col(WEIGHT).isNull()).drop(CHUNK, WEIGHT)


def running_counts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """:func:`running_totals` of rows for tables most of whose rows belong to large keys:
    rows of all keys travel and are sorted once, in chunks."""
    rows, pieces = in_chunks(df, keys, order, max_rows)
    if pieces > 1:
        counts = chunk_counts(rows, keys)
        if are_small(counts, max_rows):
            return count_along(rows, keys, order, counts, count)
    return running_totals(df, keys, order, {count: None}, max_rows)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add the value of ``column`` in the row before, per key."""
    cut = chunked(df, keys, order, max_rows)
    if not cut.split:
        w = Window.partitionBy(*cut.keys).orderBy(*order)
        return cut.rows.withColumn(name, F.lag(column).over(w))
    lasts = cut.large_rows().groupBy(*cut.groups).agg(
        F.max_by(F.struct(column), F.struct(*order)).alias("_last")
    )
    w_chunk = Window.partitionBy(*cut.keys).orderBy(CHUNK)
    carry = (
        lasts.select(*cut.groups, F.lag("_last").over(w_chunk).alias("_last"))
        .filter(F.col("_last").isNotNull())
        .select(*cut.groups, F.col(f"_last.{column}").alias(column))
    )
    w = Window.partitionBy(*cut.groups).orderBy(REAL, *order)
    return _tidy(cut.with_carry(carry).withColumn(name, F.lag(column).over(w)))


def maximum_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add the largest value of ``column`` in all rows before, per key."""
    cut = chunked(df, keys, order, max_rows)
    before = Window.unboundedPreceding, -1
    if not cut.split:
        w = Window.partitionBy(*cut.keys).orderBy(*order).rowsBetween(*before)
        return cut.rows.withColumn(name, F.max(column).over(w))
    tops = cut.large_rows().groupBy(*cut.groups).agg(F.max(column).alias(column))
    carry = tops.select(
        *cut.groups, F.max(column).over(_before(cut.keys)).alias(column)
    ).filter(F.col(column).isNotNull())
    w = Window.partitionBy(*cut.groups).orderBy(REAL, *order).rowsBetween(*before)
    return _tidy(cut.with_carry(carry).withColumn(name, F.max(column).over(w)))
