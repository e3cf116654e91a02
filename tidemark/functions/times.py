"""Event time as epoch milliseconds."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The flag of the row that ends a replayed stream; it holds nothing but a far time.
END = "end_of_stream"
# 0001-01-01, before any time that Spark reads.
FIRST_MS = -62_135_596_800_000


def pick(df: DataFrame, *columns) -> DataFrame:
    """The columns, and the end flag where the stream has one."""
    return df.select(*columns, *([END] if END in df.columns else []))


def without_end(df: DataFrame) -> DataFrame:
    """The rows of a stream without its flagged end; for operators without a watermark."""
    return df.filter(~F.col(END)).drop(END) if END in df.columns else df


def epoch_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC, rounded down.

    Counted from the calendar fields, so no time zone plays a part.
    """
    days = F.unix_date(ts_ntz.cast("date")).cast("bigint")
    seconds = F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60
    millis = F.floor(F.extract(F.lit("SECOND"), ts_ntz) * 1000)
    return days * 86_400_000 + seconds.cast("bigint") * 1000 + millis.cast("bigint")


def window_start(ms: Column, size_ms: int, slide_ms: int | None = None) -> Column:
    """Start of the latest window (every ``slide_ms``, else ``size_ms``) at ``ms``."""
    return ms - F.pmod(ms, F.lit(slide_ms or size_ms).cast("bigint"))


def truncated_window_start(ms: Column, size_ms: int) -> Column:
    """``ms / size * size`` in whole numbers, truncating towards zero."""
    size = F.lit(size_ms).cast("bigint")
    return F.call_function("div", ms, size) * size


def with_event_time(
    df: DataFrame, delay_ms: int | None = None, ms: str = "ms", ts: str = "event_time"
) -> DataFrame:
    """Add a timestamp column for ``ms``; a delay also sets the watermark.

    A flagged end moves the watermark and goes. Spark moves filters that do without the
    time, and those it derives from join keys, ahead of the watermark, where they would
    take the end away; so filter and columns are tied to the time.
    """
    timed = df.withColumn(ts, F.timestamp_millis(ms))
    if delay_ms is None:
        return without_end(timed)
    marked = timed.withWatermark(ts, f"{delay_ms} milliseconds")
    if END not in df.columns:
        return marked
    first_day = F.timestamp_millis(F.lit(FIRST_MS))
    rows = marked.filter(~F.col(END) | (F.col(ts) < first_day))
    others = [c for c in df.columns if c not in (END, ts)]
    return rows.select(*(F.when(F.col(ts) >= first_day, F.col(f"`{c}`")).alias(c) for c in others), ts)


def row_watermark(df: DataFrame, delay_ms: int, ms: str = "ms", ts: str = "event_time") -> DataFrame:
    """Watermark for operators that take or drop single rows.

    Spark drops a row whose time equals the watermark. One millisecond more of delay
    keeps rows of the latest time, and makes the watermark what
    :func:`tidemark.operators.watermark_trace` reports.
    """
    return with_event_time(df, delay_ms + 1, ms, ts)


def time_order(ms: Column, tie: Column) -> Column:
    """One number that sorts by ``ms`` and then by the whole number ``tie``.

    Unlike a struct it fits a hash aggregate's buffer.
    """
    return ms.cast("decimal(19,0)") * F.lit(Decimal(2**64)) + tie.cast("decimal(19,0)")
