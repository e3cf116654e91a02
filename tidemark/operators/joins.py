"""Two-input operators. Pairs are the result here, so nothing is cut off.

The joins are equi-joins with the time window (or time bucket) in the key, which
spreads a busy key over its windows; what stays uneven is split at run time by
the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import time_order, window_start


def _windowed(df: DataFrame, size_ms: int, ms: str) -> DataFrame:
    return df.withColumn("window_start", window_start(F.col(ms), size_ms))


def window_join(
    left: DataFrame, right: DataFrame, key: str, size_ms: int = 10_000, ms: str = "ms"
) -> DataFrame:
    """Pairs with equal key in the same tumbling window.

    Other columns must have distinct names on both sides; ``ms`` comes back as
    ``left_ms`` and ``right_ms``.
    """
    lefts = _windowed(left, size_ms, ms).withColumnRenamed(ms, "left_ms")
    rights = _windowed(right, size_ms, ms).withColumnRenamed(ms, "right_ms")
    return lefts.join(rights, [key, "window_start"])


def _last_values(right: DataFrame, key: str, value: str, tie: str, ms: str) -> DataFrame:
    """The last value per key and window, by time and then the number ``tie``."""
    return right.groupBy(key, "window_start").agg(
        F.max_by(value, time_order(F.col(ms), F.col(tie))).alias("_last")
    )


def cogroup_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    default,
    tie: str,
    size_ms: int = 10_000,
    ms: str = "ms",
) -> DataFrame:
    """Every left row with the last right ``value`` of its key and window.

    ``default`` stands in where the window has no right row. ``tie`` orders right
    rows of the same millisecond.
    """
    lasts = _last_values(_windowed(right, size_ms, ms), key, value, tie, ms)
    joined = _windowed(left, size_ms, ms).join(lasts, [key, "window_start"], "left")
    matched = F.coalesce(F.col("_last"), F.lit(default))
    return joined.withColumn(value, matched).drop("_last")


def cogroup_full_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    default,
    tie: str,
    size_ms: int = 10_000,
    ms: str = "ms",
) -> DataFrame:
    """The left join plus every right row whose key has no left row in its window.

    Left columns of the added rows are null.
    """
    pairs = cogroup_left_join(left, right, key, value, default, tie, size_ms, ms)
    present = _windowed(left, size_ms, ms).select(key, "window_start").distinct()
    unmatched = _windowed(right, size_ms, ms).join(present, [key, "window_start"], "left_anti")
    return pairs.unionByName(
        unmatched.select(key, "window_start", ms, value), allowMissingColumns=True
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    before_ms: int = 5_000,
    after_ms: int = 10_000,
    ms: str = "ms",
) -> DataFrame:
    """Pairs with equal key and ``left - before <= right <= left + after``.

    Time is cut into buckets as wide as the interval, so that a left row meets at
    most two of them and a key's rows are only compared with neighbours in time.
    """
    width = max(before_ms + after_ms, 1)
    low = F.col("left_ms") - F.lit(before_ms)
    high = F.col("left_ms") + F.lit(after_ms)
    first, last = window_start(low, width), window_start(high, width)
    buckets = F.explode(
        F.when(first == last, F.array(first)).otherwise(F.array(first, last))
    ).alias("_bucket")
    lefts = left.withColumnRenamed(ms, "left_ms").select("*", buckets)
    rights = right.withColumnRenamed(ms, "right_ms").withColumn(
        "_bucket", window_start(F.col("right_ms"), width)
    )
    joined = lefts.join(rights, [key, "_bucket"])
    return joined.filter(F.col("right_ms").between(low, high)).drop("_bucket")


def two_stream_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    within_ms: int | None = None,
    ms: str = "ms",
) -> DataFrame:
    """Every pair with equal key; ``within_ms`` bounds the time between both."""
    if within_ms is not None:
        return interval_join(left, right, key, within_ms, within_ms, ms)
    return left.withColumnRenamed(ms, "left_ms").join(
        right.withColumnRenamed(ms, "right_ms"), key
    )
