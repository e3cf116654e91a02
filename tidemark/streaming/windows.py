"""Window counts on streams; a window is reported once the watermark passes it."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import with_event_time
from tidemark.operators import top_per_group


def windowed_counts(
    stream: DataFrame,
    keys: Sequence[str],
    size_ms: int = 10_000,
    slide_ms: int | None = None,
    delay_ms: int = 0,
    count: str = "cnt",
    ms: str = "ms",
) -> DataFrame:
    """``keys, window_start, window_end, count``, with late rows dropped."""
    slide_ms = slide_ms or size_ms
    pane_ms = math.gcd(size_ms, slide_ms)
    panes = (
        with_event_time(stream, delay_ms, ms)
        .groupBy(F.window("event_time", f"{pane_ms} milliseconds").alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias(count))
    )
    if pane_ms != size_ms:  # only pane totals are copied to the windows over them
        window = F.window(
            F.col("window"), f"{size_ms} milliseconds", f"{slide_ms} milliseconds"
        ).alias("window")
        panes = panes.groupBy(window, *keys).agg(F.sum(count).alias(count))
    return panes.select(
        *keys,
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        count,
    )


def top_windows(n: int, count: str = "cnt", tie: str = "url") -> Callable[[DataFrame], DataFrame]:
    """Ranking step for the micro-batches of :func:`windowed_counts`.

    All counts of a window leave the aggregation in the batch that closes it, so a
    ranking per batch is complete and no state has to hold a window's keys.
    """
    return lambda batch: top_per_group(batch, ["window_end"], n, count, tie)
