"""What each row would see of watermarks and timers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import MAX_ROWS, maximum_before


def watermark_trace(
    df: DataFrame,
    arrival: Sequence[str],
    delay_ms: int = 0,
    ms: str = "ms",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``wm_ms``, the watermark that the row meets on arrival, and ``is_late``.

    The watermark is the largest time of all rows that arrived before, less the
    delay, less 1 ms. The first row meets none and is not late.
    """
    seen = maximum_before(df, [], arrival, ms, "_max_ms", max_rows)
    watermark = F.col("_max_ms") - F.lit(delay_ms) - F.lit(1)
    return (
        seen.withColumn("wm_ms", watermark)
        .withColumn("is_late", F.coalesce(F.col(ms) <= F.col("wm_ms"), F.lit(False)))
        .drop("_max_ms")
    )


def event_timer_trace(
    df: DataFrame,
    user: str = "user_id",
    tie: str = "event_id",
    after_ms: int = 10,
    delay_ms: int = 0,
    ms: str = "ms",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``kind, user_id, ms``: each row's arrival and the watermark it meets, and one
    firing per distinct timer, ``after_ms`` behind a row."""
    seen = watermark_trace(df, [ms, tie], delay_ms, ms, max_rows)
    arrival = F.struct(F.lit("arrival").alias("kind"), F.col(user), F.col(ms).alias("ms"))
    watermark = F.struct(F.lit("watermark").alias("kind"), F.col(user), F.col("wm_ms").alias("ms"))
    rows = seen.select(F.inline(F.array(arrival, watermark)))
    timers = (
        df.select((F.col(ms) + F.lit(after_ms)).alias("ms"))
        .distinct()
        .select(
            F.lit("timer").alias("kind"),
            F.lit(None).cast(df.schema[user].dataType).alias(user),
            "ms",
        )
    )
    return rows.unionByName(timers)
