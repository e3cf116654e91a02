"""Reconciliation of two payment streams with a timeout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import bills
from tidemark.plans.ordered import MAX_ROWS, previous_value, running_totals


def is_paid(status: Column) -> Column:
    return F.coalesce(status == "success", F.lit(False))


def check_outcomes(timeout_ms: int) -> Column:
    """Outcomes of one order from ``app_ms``, ``third_ms`` and ``paid``, as an array
    of (outcome, fire_ms)."""
    app_ms, third_ms, limit = F.col("app_ms"), F.col("third_ms"), F.lit(timeout_ms)
    third_missing = F.struct(F.lit("third_timeout").alias("outcome"), (app_ms + limit).alias("fire_ms"))
    app_missing = F.struct(F.lit("app_timeout").alias("outcome"), (third_ms + limit).alias("fire_ms"))
    failed = F.struct(
        F.lit("payment_failed").alias("outcome"),
        (F.least(app_ms, third_ms) + limit).alias("fire_ms"),
    )
    by_third = F.struct(F.lit("third_matched").alias("outcome"), third_ms.alias("fire_ms"))
    by_app = F.struct(F.lit("app_matched").alias("outcome"), app_ms.alias("fire_ms"))

    return (
        F.when(third_ms.isNull(), F.array(third_missing))
        .when(app_ms.isNull(), F.array(app_missing))
        .when(F.abs(app_ms - third_ms) > limit, F.array(third_missing, app_missing))
        .when(~F.col("paid"), F.array(failed))
        .when(app_ms <= third_ms, F.array(by_third))
        .otherwise(F.array(by_app))
    )


def bill_check(app: DataFrame, third: DataFrame, timeout_ms: int = 5_000) -> DataFrame:
    """``order_id, outcome, fire_ms`` for app orders and third-party payments.

    An order waits ``timeout_ms`` for its other half; a half that arrives exactly
    at the deadline still counts. The later half of a good pair names the match.
    An order id may occur once per side; a second occurrence is an error, not
    silently merged; :func:`bill_check_repeated` takes those. Rows without order id or
    time are left out. Both sides go through one shuffle on the order id.
    """
    known = F.col("order_id").isNotNull() & F.col("ts_ms").isNotNull()
    app, third = app.filter(known), third.filter(known)
    sides = app.select(
        "order_id",
        F.col("ts_ms").alias("app_ms"),
        F.lit(None).cast("bigint").alias("third_ms"),
        F.lit(None).cast("boolean").alias("paid"),
    ).unionByName(
        third.select(
            "order_id",
            F.lit(None).cast("bigint").alias("app_ms"),
            F.col("ts_ms").alias("third_ms"),
            is_paid(F.col("status")).alias("paid"),
        )
    )
    orders = sides.groupBy("order_id").agg(
        F.max("app_ms").alias("app_ms"),
        F.max("third_ms").alias("third_ms"),
        F.max("paid").alias("paid"),
        F.greatest(F.count("app_ms"), F.count("third_ms")).alias("_times"),
    )
    repeated = F.raise_error(F.concat_ws(" ", F.lit("order id occurs twice:"), "order_id"))
    orders = orders.withColumn(
        "app_ms", F.when(F.col("_times") > 1, repeated.cast("bigint")).otherwise(F.col("app_ms"))
    )
    return orders.select("order_id", F.inline(check_outcomes(timeout_ms)))


def bill_check_repeated(
    app: DataFrame, third: DataFrame, timeout_ms: int = 5_000, max_rows: int = MAX_ROWS
) -> DataFrame:
    """:func:`bill_check` for order ids that may come again.

    Each row of a side replaces the one waiting there and sets a timer of its own; any
    timer of the order ends the wait of both halves. Rows of one time count app first,
    then by status. Rows without order id or time are left out.

    Where an order rests for longer than the timeout nothing waits any more, so its rows
    are cut there into sessions that are followed apart; a session streams through
    one task, which holds two halves and their timers.
    """
    known = F.col("order_id").isNotNull() & F.col("ts_ms").isNotNull()
    rows = app.filter(known).select(
        "order_id", F.lit(0).alias("side"), F.lit("").alias("status"), "ts_ms"
    ).unionByName(
        third.filter(known).select(
            "order_id", F.lit(1).alias("side"), F.coalesce("status", F.lit("")).alias("status"), "ts_ms"
        )
    )
    order = ["ts_ms", "side", "status"]
    timed = previous_value(rows, ["order_id"], order, "ts_ms", "_prev", max_rows)
    rested = F.coalesce(F.col("ts_ms") - F.col("_prev") > timeout_ms, F.lit(False))
    timed = timed.withColumn("_rested", rested.cast("bigint")).drop("_prev")
    sessions = running_totals(timed, ["order_id"], order, {"session": "_rested"}, max_rows)
    return (
        sessions.drop("_rested")
        .repartition("order_id", "session")
        .sortWithinPartitions("order_id", "session", *order)
        .mapInArrow(bills.reporter(timeout_ms), "order_id string, outcome string, fire_ms bigint")
    )
