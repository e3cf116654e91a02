"""Event-time window counts and rankings.

Window bounds are epoch milliseconds, half open: ``[window_start, window_end)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import truncated_window_start, window_start


def windowed_counts(
    df: DataFrame,
    keys: Sequence[str],
    size_ms: int = 10_000,
    slide_ms: int | None = None,
    count: str = "cnt",
    ms: str = "ms",
) -> DataFrame:
    """Rows per key and tumbling or sliding window.

    Sliding windows are sums of panes: each row is counted once, in a pane as wide
    as the common divisor of size and slide, and only pane totals are copied to
    the windows which cover them.
    """
    slide_ms = slide_ms or size_ms
    pane_ms = math.gcd(size_ms, slide_ms)
    panes = df.groupBy(*keys, window_start(F.col(ms), pane_ms).alias("_pane")).agg(
        F.count(F.lit(1)).alias(count)
    )
    bounds = [
        F.col("window_start"),
        (F.col("window_start") + F.lit(size_ms)).alias("window_end"),
    ]
    if size_ms == slide_ms:
        return panes.withColumnRenamed("_pane", "window_start").select(*keys, *bounds, count)
    starts = F.explode(_covering_starts(F.col("_pane"), size_ms, slide_ms))
    spread = panes.select(*keys, starts.alias("window_start"), count)
    return (
        spread.groupBy(*keys, "window_start")
        .agg(F.sum(count).alias(count))
        .select(*keys, *bounds, count)
    )


def _covering_starts(pane: Column, size_ms: int, slide_ms: int) -> Column:
    """Starts of all windows that contain the pane; none when slide leaves a gap."""
    last = window_start(pane, slide_ms)
    # the earliest start whose window still reaches past the pane
    first = last - F.call_function("div", last - pane + F.lit(size_ms - 1), F.lit(slide_ms)) * F.lit(
        slide_ms
    )
    starts = F.sequence(first, last, F.lit(slide_ms).cast("bigint"))
    return F.when(last + F.lit(size_ms) > pane, starts)


def truncated_window_counts(
    df: DataFrame, keys: Sequence[str], size_ms: int = 10_000, count: str = "pv", ms: str = "ms"
) -> DataFrame:
    """Tumbling counts whose window comes from ``ms / size * size``."""
    start = truncated_window_start(F.col(ms), size_ms).alias("window_start")
    counted = df.groupBy(*keys, start).agg(F.count(F.lit(1)).alias(count))
    return counted.select(
        *keys, "window_start", (F.col("window_start") + F.lit(size_ms)).alias("window_end"), count
    )


def counts_as_text(counts: DataFrame, key: str = "url", count: str = "cnt") -> DataFrame:
    """Add ``message`` with the reported wording of a count."""
    # Fixed wording.
    return counts.withColumn("message", F.format_string("Url:%s数量为:%d", F.col(key), F.col(count)))


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    n: int,
    count: str = "cnt",
    tie: str = "url",
    rank: str = "rank",
) -> DataFrame:
    """The ``n`` largest counts per group, ties by ``tie``; fewer when there are fewer.

    Spark limits each partition to ``n`` rows per group before it shuffles.
    """
    w = Window.partitionBy(*group).orderBy(F.desc(count), tie)
    ranked = df.withColumn(rank, F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col(rank) <= n)
