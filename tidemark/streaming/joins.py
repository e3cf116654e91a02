"""Two-input operators on streams. State leaves as the slower input's watermark
passes; unmatched rows appear at that moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import END, row_watermark, time_order, window_start, with_event_time, without_end


def _windowed(df: DataFrame, size_ms: int, delay_ms: int, ms: str) -> DataFrame:
    timed = with_event_time(df, delay_ms, ms)
    return timed.withColumn("window", F.window("event_time", f"{size_ms} milliseconds"))


def _window_ms(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.unix_millis("window.start")).drop("window")


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    size_ms: int = 10_000,
    delay_ms: int = 0,
    ms: str = "ms",
) -> DataFrame:
    """Pairs with equal key in the same tumbling window."""
    lefts = _windowed(left, size_ms, delay_ms, ms).withColumnRenamed(ms, "left_ms")
    rights = _windowed(right, size_ms, delay_ms, ms).withColumnRenamed(ms, "right_ms")
    pairs = lefts.drop("event_time").join(rights.drop("event_time"), [key, "window"])
    return _window_ms(pairs)


def _last_values(rights: DataFrame, key: str, value: str, tie: str, ms: str) -> DataFrame:
    return rights.groupBy(key, "window").agg(
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
    delay_ms: int = 0,
    ms: str = "ms",
) -> DataFrame:
    """Every left row with the last right ``value`` of its key and window, else
    ``default``."""
    lefts = _windowed(left, size_ms, delay_ms, ms).drop("event_time")
    lasts = _last_values(_windowed(right, size_ms, delay_ms, ms), key, value, tie, ms)
    joined = lefts.join(lasts, [key, "window"], "left")
    matched = F.coalesce(F.col("_last"), F.lit(default))
    return _window_ms(joined.withColumn(value, matched).drop("_last"))


def cogroup_full_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    default,
    tie: str,
    size_ms: int = 10_000,
    delay_ms: int = 0,
    ms: str = "ms",
) -> DataFrame:
    """The left join plus every right row whose key has no left row in its window."""
    pairs = cogroup_left_join(left, right, key, value, default, tie, size_ms, delay_ms, ms)
    present = (
        _windowed(left, size_ms, delay_ms, ms)
        .groupBy(key, "window")
        .agg(F.lit(True).alias("_present"))
    )
    rights = _windowed(right, size_ms, delay_ms, ms).drop("event_time")
    unmatched = rights.join(present, [key, "window"], "left").filter(F.col("_present").isNull())
    return pairs.unionByName(
        _window_ms(unmatched).select(key, "window_start", ms, value), allowMissingColumns=True
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    before_ms: int = 5_000,
    after_ms: int = 10_000,
    delay_ms: int = 0,
    ms: str = "ms",
) -> DataFrame:
    """Pairs with equal key and ``left - before <= right <= left + after``.

    Time buckets in the join key keep a busy key's state in many small groups; the
    time range lets Spark drop state.
    """
    width = max(before_ms + after_ms, 1)
    low, high = F.col(ms) - F.lit(before_ms), F.col(ms) + F.lit(after_ms)
    first, last = window_start(low, width), window_start(high, width)
    spread = F.when(first == last, F.array(first)).otherwise(F.array(first, last))
    lefts = (
        row_watermark(left, delay_ms, ms, "left_time")
        .withColumn("_bucket", F.explode(spread))
        .withColumnRenamed(ms, "left_ms")
    )
    rights = (
        row_watermark(right, delay_ms, ms, "right_time")
        .withColumn("_right_bucket", window_start(F.col(ms), width))
        .withColumnRenamed(ms, "right_ms")
        .withColumnRenamed(key, "_right_key")
    )
    condition = F.expr(
        f"`{key}` = _right_key and _bucket = _right_bucket"
        f" and right_time >= left_time - interval {before_ms / 1000} seconds"
        f" and right_time <= left_time + interval {after_ms / 1000} seconds"
    )
    return lefts.join(rights, condition).drop(
        "_bucket", "_right_bucket", "_right_key", "left_time", "right_time"
    )


def two_stream_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    within_ms: int | None = None,
    delay_ms: int = 0,
    ms: str = "ms",
    hot: Column | None = None,
    salts: int = 1,
) -> DataFrame:
    """Every pair with equal key. Without ``within_ms`` all rows stay in state.

    Keys for which the condition ``hot`` holds are dealt out: a left row goes to one of
    ``salts`` groups by a hash of it, a right row to all of them, so pairs meet once and
    the state of such a key lies in as many places.
    """
    if hot is not None and salts > 1:
        dealt = F.pmod(F.xxhash64(*(f"`{c}`" for c in left.columns if c != END)), F.lit(salts))
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        first = F.lit(0).cast("bigint")
        left = left.withColumn("_salt", F.when(hot, dealt).otherwise(first))
        right = right.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(first))))
        both = F.struct(F.col(key).alias("key"), F.col("_salt").alias("salt"))
        left = left.withColumn("_dealt", F.when(F.col(key).isNotNull(), both)).drop("_salt")
        right = right.withColumn("_dealt", F.when(F.col(key).isNotNull(), both)).drop("_salt", key)
        return two_stream_join(left, right, "_dealt", within_ms, delay_ms, ms).drop("_dealt")
    if within_ms is not None:
        return interval_join(left, right, key, within_ms, within_ms, delay_ms, ms)
    lefts, rights = without_end(left), without_end(right)
    return lefts.withColumnRenamed(ms, "left_ms").join(rights.withColumnRenamed(ms, "right_ms"), key)
