"""The registered queries on the supplied tables, and their DuckDB equivalents.

Windows and timeouts are hours here because the supplied events are minutes
apart; the operators' defaults are seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources
from tidemark.functions import split_lines

HOUR = 3_600_000
DAY = 24 * HOUR
# 2024-01-16 00:00:00 UTC, when the second action pattern takes over.
SECOND_PATTERN_MS = 1_705_363_200_000
ID = "event_id"


def _of_url(events: DataFrame, url: str, id_name: str) -> DataFrame:
    kept = events.filter(F.col("url") == url)
    return kept.select("user_id", F.col(ID).alias(id_name), "ms")


def word_count(spark, data_dir):
    documents = sources.documents(spark, data_dir)
    return ops.word_count(documents.select(F.explode(split_lines(F.col("text"))).alias("line")))


def running_word_count(spark, data_dir):
    return ops.running_word_count(ops.document_words(sources.documents(spark, data_dir)))


def url_tumbling_count(spark, data_dir):
    return ops.windowed_counts(sources.click_events(spark, data_dir), ["url"], HOUR)


def url_count_text(spark, data_dir):
    return ops.counts_as_text(url_tumbling_count(spark, data_dir)).select(
        "window_start", "message"
    )


def fake_window_pv(spark, data_dir):
    return ops.truncated_window_counts(sources.click_events(spark, data_dir), ["url"], HOUR)


def url_sliding_count(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    return ops.windowed_counts(events, ["url"], 2 * HOUR, HOUR)


def url_topn_keyed(spark, data_dir, n=3):
    counts = url_sliding_count(spark, data_dir)
    return ops.top_per_group(counts, ["window_end"], n).select("window_end", "rank", "url", "cnt")


def url_topn_all(spark, data_dir):
    return url_topn_keyed(spark, data_dir, n=2)


def window_join(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    clicks = _of_url(events, "click", "click_id")
    purchases = _of_url(events, "purchase", "purchase_id")
    return ops.window_join(clicks, purchases, "user_id", DAY).select(
        "user_id", "window_start", "click_id", "purchase_id"
    )


def _cogroup(spark, data_dir, join):
    events = sources.click_events(spark, data_dir)
    clicks = _of_url(events, "click", "left_id")
    purchases = _of_url(events, "purchase", "right_id").withColumn("right_val", F.col("right_id"))
    return join(clicks, purchases, "user_id", "right_val", -1, "right_id", DAY).select(
        "user_id", "window_start", F.coalesce("left_id", F.lit(-1)).alias("left_id"), "right_val"
    )


def cogroup_left_join(spark, data_dir):
    return _cogroup(spark, data_dir, ops.cogroup_left_join)


def cogroup_full_join(spark, data_dir):
    return _cogroup(spark, data_dir, ops.cogroup_full_join)


def interval_join(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    purchases = _of_url(events, "purchase", "purchase_id")
    clicks = _of_url(events, "click", "click_id")
    return ops.interval_join(purchases, clicks, "user_id", 5 * HOUR, 10 * HOUR).select(
        "user_id", "purchase_id", "click_id"
    )


def two_stream_join(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    signups, errors = _of_url(events, "signup", "left_id"), _of_url(events, "error", "right_id")
    return ops.two_stream_join(signups, errors, "user_id").select(
        "user_id", "left_id", "right_id"
    )


def two_stream_join_within(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    signups, errors = _of_url(events, "signup", "left_id"), _of_url(events, "error", "right_id")
    return ops.two_stream_join(signups, errors, "user_id", within_ms=DAY).select(
        "user_id", "left_id", "right_id"
    )


def bill_check(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    return ops.bill_check(sources.app_orders(events), sources.third_orders(events), 6 * HOUR)


def again(orders, times=3):
    """Only so many order ids per user, so that each comes again and again."""
    k = F.substring_index("order_id", "-", -1)
    user = F.expr("substring(order_id, 1, length(order_id) - length(substring_index(order_id, '-', -1)) - 1)")
    return orders.withColumn("order_id", F.concat_ws("-", user, (k.cast("bigint") % times).cast("string")))


def bill_check_repeated(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    sides = again(sources.app_orders(events)), again(sources.third_orders(events))
    return ops.bill_check_repeated(*sides, 6 * HOUR)


def action_patterns(events: DataFrame) -> DataFrame:
    """view→click from the first event on, click→purchase from mid-January."""
    names = "action1 string, action2 string, ms bigint"
    first = F.struct(F.lit("view"), F.lit("click"), F.min("ms"))
    second = F.struct(F.lit("click"), F.lit("purchase"), F.lit(SECOND_PATTERN_MS))
    rows = F.array(first, second).cast(f"array<struct<{names}>>")
    return events.agg(rows.alias("rows")).select(F.inline("rows"))


def pattern_match(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    actions = events.select("user_id", ID, "ms", F.col("url").alias("action"))
    return ops.match_patterns(actions, action_patterns(events))


def periodic_pv(spark, data_dir):
    return ops.periodic_counts(sources.click_events(spark, data_dir), ["user_id"], 6 * HOUR)


def avg_ts_every_n(spark, data_dir):
    return ops.average_every_n(sources.click_events(spark, data_dir), ["user_id"], 5)


def _sharded(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    return events.withColumn("shard", F.col("user_id") % 4)


def buffered_chunks(spark, data_dir):
    return ops.chunk_summaries(_sharded(spark, data_dir).select("shard", ID))


def buffered_rows(spark, data_dir):
    return ops.full_chunks(_sharded(spark, data_dir).select("shard", ID))


def event_timer_trace(spark, data_dir):
    return ops.event_timer_trace(sources.click_events(spark, data_dir))


def watermark_trace(spark, data_dir):
    events = sources.click_events(spark, data_dir).select(ID, "ms")
    arrival = F.col(ID) + (F.col(ID) * 7919) % 41
    return ops.watermark_trace(
        events.withColumn("arrival", arrival), ["arrival", ID], HOUR
    ).select(ID, "wm_ms", "is_late")


def route_alerts(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    return ops.route_alerts(
        events, ["click", "purchase"], by="url", name="user_id", url="url", ms="ms"
    ).select(ID, "route", "message")


def split_by_user(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    return ops.split_by_user(events, {1: "user-1", 2: "user-2"}, user="user_id").select(
        "route", "user_id", "url", "ms"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": word_count,
    "running_word_count": running_word_count,
    "url_tumbling_count": url_tumbling_count,
    "url_count_text": url_count_text,
    "fake_window_pv": fake_window_pv,
    "url_sliding_count": url_sliding_count,
    "url_topn_keyed": url_topn_keyed,
    "url_topn_all": url_topn_all,
    "window_join": window_join,
    "cogroup_left_join": cogroup_left_join,
    "cogroup_full_join": cogroup_full_join,
    "interval_join": interval_join,
    "two_stream_join": two_stream_join,
    "two_stream_join_within": two_stream_join_within,
    "bill_check": bill_check,
    "bill_check_repeated": bill_check_repeated,
    "pattern_match": pattern_match,
    "periodic_pv": periodic_pv,
    "avg_ts_every_n": avg_ts_every_n,
    "buffered_chunks": buffered_chunks,
    "buffered_rows": buffered_rows,
    "event_timer_trace": event_timer_trace,
    "watermark_trace": watermark_trace,
    "route_alerts": route_alerts,
    "split_by_user": split_by_user,
}
