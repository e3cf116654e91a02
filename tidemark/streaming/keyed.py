"""Per-key stateful operators on streams.

Rows of one key are put in order within a micro-batch; the source's batch size
bounds how many those are. Between batches only the key's small state remains.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import pick, row_watermark, without_end
from tidemark.operators.patterns import MAX_BROADCAST_PATTERNS, match_moves
from tidemark.operators.reconcile import check_outcomes, is_paid
from tidemark.streaming import processors as p
from tidemark.streaming.blocks import BLOCK, packed, unpacked


def _run(
    stream: DataFrame,
    keys: Sequence[str],
    processor: p.Processor,
    added: dict[str, T.DataType],
    timed: bool = True,
) -> DataFrame:
    schema = T.StructType(
        [T.StructField(k, stream.schema[k].dataType) for k in keys]
        + [T.StructField(name, kind) for name, kind in added.items()]
    )
    return stream.groupBy(*keys).transformWithState(
        statefulProcessor=processor.named(schema.names),
        outputStructType=schema,
        outputMode="append",
        timeMode="eventTime" if timed else "none",
    )


def periodic_counts(
    stream: DataFrame,
    keys: Sequence[str],
    period_ms: int = 10_000,
    delay_ms: int = 0,
    count: str = "pv",
    ms: str = "ms",
) -> DataFrame:
    """``keys, fire_ms, count``: a key's total row count at the end of each cycle."""
    slim = row_watermark(pick(stream, *keys, F.col(ms).alias("ms")), delay_ms)
    added = {"fire_ms": T.LongType(), count: T.LongType()}
    return _run(slim, keys, p.CycleCounter(period_ms), added)


def average_every_n(
    stream: DataFrame,
    keys: Sequence[str],
    n: int = 5,
    delay_ms: int = 0,
    ms: str = "ms",
    tie: str = "event_id",
) -> DataFrame:
    """``keys, nth, avg_ms`` at every n-th row of a key, over all its rows so far."""
    slim = pick(stream, *keys, F.col(ms).alias("ms"), F.col(tie).alias("id"))
    added = {"nth": T.LongType(), "avg_ms": T.LongType()}
    return _run(row_watermark(slim, delay_ms), keys, p.AverageEveryN(n), added)


def bill_check(
    app: DataFrame, third: DataFrame, timeout_ms: int = 5_000, delay_ms: int = 0
) -> DataFrame:
    """``order_id, outcome, fire_ms`` for order ids that occur once per side.

    A full outer join in time: pairs come out at once, a half without partner when
    the watermark passes its deadline. Each side brings its own watermark, and the
    slower one holds time back.
    """
    apps = row_watermark(pick(app, "order_id", "ts_ms"), delay_ms, "ts_ms", "app_time")
    thirds = row_watermark(
        pick(
            third,
            F.col("order_id").alias("third_id"),
            is_paid(F.col("status")).alias("paid"),
            F.col("ts_ms").alias("third_ms"),
        ),
        delay_ms,
        "third_ms",
        "third_time",
    )
    limit = f"interval {timeout_ms / 1000} seconds"
    near = F.expr(
        "order_id = third_id"
        f" and third_time >= app_time - {limit} and third_time <= app_time + {limit}"
    )
    halves = apps.withColumnRenamed("ts_ms", "app_ms").join(thirds, near, "full_outer")
    return halves.select(
        F.coalesce("order_id", "third_id").alias("order_id"), F.inline(check_outcomes(timeout_ms))
    ).filter("order_id is not null")


def bill_check_repeated(
    app: DataFrame, third: DataFrame, timeout_ms: int = 5_000, delay_ms: int = 0
) -> DataFrame:
    """:func:`bill_check` for order ids that may come again.

    Each row of a side replaces the one waiting there and sets a timer of its own;
    any timer of the order ends the wait of both halves.
    """
    apps = pick(
        app, "order_id", F.lit(0).alias("side"), F.lit(None).cast("string").alias("status"), "ts_ms"
    )
    thirds = pick(third, "order_id", F.lit(1).alias("side"), "status", "ts_ms")
    both = row_watermark(apps, delay_ms, "ts_ms").unionByName(
        row_watermark(thirds, delay_ms, "ts_ms")
    )
    both = both.filter("order_id is not null")
    added = {"outcome": T.StringType(), "fire_ms": T.LongType()}
    return _run(both, ["order_id"], p.BillCheck(timeout_ms), added)


def full_chunks(
    stream: DataFrame,
    shard: str = "shard",
    order: Sequence[str] = ("event_id",),
    size: int = 10,
) -> DataFrame:
    """The rows of each buffer of ``size`` as it fills, with ``chunk``; the rest is
    held in state and survives a restart. Rows go through the operator in blocks, as a
    shard may have most of a micro-batch's."""
    stream = without_end(stream)
    held = T.StructType([f for f in stream.schema.fields if f.name != shard])
    kinds = {shard: stream.schema[shard].dataType, "chunk": T.LongType(), **{f.name: f.dataType for f in held.fields}}
    filled = _run(
        packed(stream, shard), [shard], p.FullChunkBlocks(held, list(order), size), {BLOCK: T.BinaryType()}, timed=False
    )
    return unpacked(filled, shard, T.StructType([T.StructField(name, kind) for name, kind in kinds.items()]))


def event_timer_trace(
    stream: DataFrame,
    user: str = "user_id",
    after_ms: int = 10,
    delay_ms: int = 0,
    watermarks: bool = True,
    shards: int | None = None,
    ms: str = "ms",
) -> DataFrame:
    """``kind, user_id, ms``: arrivals, the watermark each meets, and one firing per
    distinct timer, once the watermark passes it.

    Only reading the watermark takes a stateful operator, whose single key is
    sharded; ``watermarks=False`` leaves it out.
    """
    if watermarks:
        shards = shards or 4 * stream.sparkSession.sparkContext.defaultParallelism
        shard = F.pmod(F.xxhash64(ms), F.lit(shards)).alias("shard")
        slim = pick(stream, shard, F.col(user).alias("user"), F.col(ms).alias("ms"))
        added = {"kind": T.StringType(), user: stream.schema[user].dataType, ms: T.LongType()}
        seen = _run(row_watermark(slim, delay_ms), ["shard"], p.SeenWatermarks(), added)
        rows = seen.drop("shard")
    else:
        rows = without_end(stream).select(F.lit("arrival").alias("kind"), user, ms)
    due = pick(stream, (F.col(ms) + F.lit(after_ms)).alias("ms"))
    timers = row_watermark(due, delay_ms + after_ms).groupBy("event_time").agg(
        F.lit("timer").alias("kind")
    )
    return rows.unionByName(
        timers.select(
            "kind",
            F.lit(None).cast(stream.schema[user].dataType).alias(user),
            F.unix_millis("event_time").alias(ms),
        )
    )


def previous_actions(
    stream: DataFrame, user: str = "user_id", tie: str = "event_id", ms: str = "ms"
) -> DataFrame:
    """``user, event, ms, action, prev_action`` for each row with an action before it."""
    slim = without_end(stream).select(user, F.col(tie).alias("id"), F.col(ms).alias("ms"), "action")
    added = {
        tie: stream.schema[tie].dataType,
        ms: T.LongType(),
        "action": T.StringType(),
        "prev_action": T.StringType(),
    }
    return _run(slim, [user], p.PreviousAction(), added, timed=False)


def controlled_matches(
    actions: DataFrame,
    patterns: DataFrame,
    user: str = "user_id",
    tie: str = "event_id",
    delay_ms: int = 0,
    shards: int | None = None,
    ms: str = "ms",
) -> DataFrame:
    """``user, event, action1, action2`` where a user's last and present action are the
    pattern in force, with the patterns as a stream of their own.

    A pattern (``action1, action2, ms``) holds from its time until the next one's. Rows
    wait until the watermark of both streams, which is the slower one's, has passed
    them, and are then followed in order of time, a pattern before actions of its
    time. So the result does not depend on how the two streams interleave. Patterns go
    to every shard of users; waiting rows are those between the two streams' times.
    """
    shards = shards or 4 * actions.sparkSession.sparkContext.defaultParallelism
    kinds = {c: actions.schema[c].dataType for c in (user, tie)}
    texts = {c: F.lit(None).cast("string").alias(c) for c in ("action", "action1", "action2")}
    moves = pick(
        actions, F.pmod(F.xxhash64(user), F.lit(shards)).alias("shard"), F.lit(1).alias("kind"),
        F.col(ms).alias("ms"), F.col(tie).alias("id"), F.col(user).alias("user"),
        "action", texts["action1"], texts["action2"],
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    rules = pick(
        patterns, every.alias("shard"), F.lit(0).alias("kind"), F.col("ms"),
        F.lit(None).cast(kinds[tie]).alias("id"), F.lit(None).cast(kinds[user]).alias("user"),
        texts["action"], "action1", "action2",
    )
    both = row_watermark(moves, delay_ms).unionByName(row_watermark(rules, delay_ms))
    added = {user: kinds[user], tie: kinds[tie], "action1": T.StringType(), "action2": T.StringType()}
    processor = p.ControlledMatch(kinds[user].simpleString(), kinds[tie].simpleString())
    return _run(both, ["shard"], processor, added).drop("shard")


def pattern_matches(
    patterns: Callable[[], DataFrame],
    user: str = "user_id",
    tie: str = "event_id",
    max_broadcast: int = MAX_BROADCAST_PATTERNS,
) -> Callable[[DataFrame], DataFrame]:
    """Matching step for the micro-batches of :func:`previous_actions`.

    ``patterns`` reads the pattern table, anew for every micro-batch, so its size is
    checked each time and changes take effect.
    """
    return lambda moves: match_moves(moves, patterns(), user, tie, max_broadcast=max_broadcast)
