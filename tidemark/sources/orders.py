"""Order streams of the two payment platforms, projected from click events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import MAX_ROWS, running_totals

# Third-party payments below this value count as failed.
FAIL_BELOW = 20.0


def _numbered(events: DataFrame, url: str, max_rows: int) -> DataFrame:
    """The k-th event of a user gets the order id ``user-k``."""
    kept = events.filter(F.col("url") == url).select("user_id", "event_id", "ms", "value")
    ranked = running_totals(kept, ["user_id"], ["ms", "event_id"], {"k": None}, max_rows)
    return ranked.select(
        F.concat_ws("-", "user_id", "k").alias("order_id"), "value", F.col("ms").alias("ts_ms")
    )


def app_orders(events: DataFrame, url: str = "click", max_rows: int = MAX_ROWS) -> DataFrame:
    """``order_id, platform, ts_ms`` of the orders placed in the app."""
    return _numbered(events, url, max_rows).select(
        "order_id", F.lit("app").alias("platform"), "ts_ms"
    )


def third_orders(
    events: DataFrame, url: str = "purchase", max_rows: int = MAX_ROWS
) -> DataFrame:
    """``order_id, platform, status, ts_ms`` of third-party payments."""
    return _numbered(events, url, max_rows).select(
        "order_id",
        F.lit("third").alias("platform"),
        F.when(F.col("value") < FAIL_BELOW, "fail").otherwise("success").alias("status"),
        "ts_ms",
    )
