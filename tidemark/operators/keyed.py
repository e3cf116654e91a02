"""Per-key statistics over the whole history of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import cycles
from tidemark.plans.ordered import CHUNK, LARGE, MAX_ROWS, REAL, chunked, running_totals

LOW_BITS = 20


def average_every_n(
    df: DataFrame,
    keys: Sequence[str],
    n: int = 5,
    ms: str = "ms",
    tie: str = "event_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``keys, nth, avg_ms`` at every n-th row of a key: the whole-number mean of all
    its times so far. The mean is never reset.

    A busy key's times overflow a long sum, so high and low bits are summed apart.
    """
    time = F.col(ms)
    halves = df.select(
        *keys,
        ms,
        tie,
        F.shiftright(time, LOW_BITS).alias("_high"),
        time.bitwiseAND(F.lit(2**LOW_BITS - 1)).alias("_low"),
    )
    totals = running_totals(
        halves, keys, [ms, tie], {"nth": None, "_highs": "_high", "_lows": "_low"}, max_rows
    )
    parts = totals.filter(F.col("nth") % n == 0).withColumn("_left", F.pmod("_highs", "nth"))
    parts = parts.withColumn("_rest", F.shiftleft("_left", LOW_BITS) + F.col("_lows"))
    mean = F.shiftleft(F.expr("(_highs - _left) div nth"), LOW_BITS) + F.expr("_rest div nth")
    # Whole-number division goes towards zero.
    round_up = (mean < 0) & (F.col("_rest") % F.col("nth") != 0)
    return parts.select(*keys, "nth", (mean + round_up.cast("int")).alias("avg_ms"))


def periodic_counts(
    df: DataFrame,
    keys: Sequence[str],
    period_ms: int = 10_000,
    count: str = "pv",
    ms: str = "ms",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``keys, fire_ms, count``: a key's total row count at the end of each cycle.

    A cycle opens at the first row without an open cycle and ends ``period_ms``
    later; rows up to and including the end count. The last cycle is reported too.

    Tasks read their rows in order and keep one cycle in memory. Where a key is cut
    into chunks, each chunk is first reduced to a step function from the cycle it
    may inherit to the cycle it leaves open; these are chained per key, and then
    every chunk is counted on its own.
    """
    keys = list(keys)
    slim = df.select(*keys, F.col(ms).alias("ms"))
    out = T.StructType(
        [slim.schema[k] for k in keys]
        + [T.StructField("fire_ms", T.LongType()), T.StructField(count, T.LongType())]
    )
    cut = chunked(slim, keys, ["ms"], max_rows)
    if not cut.split:
        ordered = slim.withColumn("n", F.lit(1).cast("bigint"))
        ordered = ordered.repartition(*keys).sortWithinPartitions(*keys, "ms")
        return ordered.mapInArrow(cycles.counter(keys, out, period_ms), out)

    # Equal times act as one row, so a chunk of a large key holds each time once.
    times = cut.large_rows().groupBy(*cut.groups, "ms").agg(F.count(F.lit(1)).alias("n"))
    small = cut.rows.filter(~F.col(LARGE)).select(
        *cut.groups, "ms", F.lit(1).cast("bigint").alias("n")
    )
    group_fields = [times.schema[k] for k in cut.groups]
    steps_schema = T.StructType(
        [
            *group_fields,
            T.StructField("n", T.LongType()),
            T.StructField("upto", T.ArrayType(T.LongType())),
            T.StructField("exits", T.ArrayType(T.LongType())),
        ]
    )
    steps = (
        times.repartition(*cut.groups)
        .sortWithinPartitions(*cut.groups, "ms")
        .mapInArrow(cycles.stepper(cut.groups, steps_schema, period_ms), steps_schema)
    )
    entry_schema = T.StructType(
        [
            *group_fields,
            T.StructField("ms", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("goes_on", T.BooleanType()),
        ]
    )
    entries = (
        steps.repartition(*keys)
        .sortWithinPartitions(*keys, CHUNK)
        .mapInArrow(cycles.chainer(keys, CHUNK, entry_schema), entry_schema)
    )
    rows = (
        times.unionByName(small)
        .withColumn(REAL, F.lit(1))
        .unionByName(entries.withColumn(REAL, F.lit(0)), allowMissingColumns=True)
        .repartition(*cut.groups)
        .sortWithinPartitions(*cut.groups, REAL, "ms")
    )
    return rows.mapInArrow(cycles.counter(keys, out, period_ms, carry=True), out)
