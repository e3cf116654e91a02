"""The registered streaming queries: each replays the stored tables as a stream,
runs until all input is read and returns what was written.

Rows come in order of time over any number of micro-batches, and a flagged end closes
what is open, so streams report what tables do. A query fails if a row came too late and
was dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.functions import END, pick, split_lines, without_end
from tidemark.queries import DAY, HOUR, ID, action_patterns, again
from tidemark.schemas import DOCUMENTS_TABLE, EVENTS_TABLE
from tidemark.session import delete_at_end, scratch_dir, written
from tidemark.sinks import latest_values
from tidemark.sinks import run_available_now as run_stream
from tidemark.sources.events import clicks_of
from tidemark.sources.replay import END_MS


def run_available_now(stream, **options):
    return run_stream(stream, refuse_late=True, drain=True, **options)


class Clicks:
    """The click events as a stream in order of time, as often as asked."""

    def __init__(self, spark, data_dir, order="ts", end=True, cuts=None):
        self.spark, self.order, self.end = spark, order, end
        self.path = f"{data_dir}/events.parquet"
        self.cuts = cuts or sources.range_cuts(spark.read.schema(EVENTS_TABLE).parquet(self.path), order)

    def stream(self, **options):
        end = {"ts": 1000 * END_MS} if self.end else None
        rows = sources.replay(self.spark, self.path, EVENTS_TABLE, self.order, end, self.cuts, **options)
        return clicks_of(rows)

    def of_url(self, url, id_name):
        rows = self.stream()
        kept = rows.filter((F.col("url") == url) | F.col(END))
        return pick(kept, "user_id", F.col(ID).alias(id_name), "ms")


def _clicks(spark, data_dir):
    return Clicks(spark, data_dir).stream()


def word_count(spark, data_dir):
    documents = sources.documents(spark, data_dir, stream=True)
    lines = documents.select(F.explode(split_lines(F.col("text"))).alias("line"))
    updates = run_available_now(ops.word_count(lines), mode="update")
    return latest_values(updates, ["word"], "cnt")


def running_word_count(spark, data_dir):
    path = f"{data_dir}/documents.parquet"
    documents = sources.replay(spark, path, DOCUMENTS_TABLE, "doc_id").select("doc_id", "text")
    return streaming.running_totals(
        ops.document_words(documents), ["word"], ["doc_id", "line_no", "pos"], "running", drain=True
    )


def url_tumbling_count(spark, data_dir):
    counts = streaming.windowed_counts(_clicks(spark, data_dir), ["url"], HOUR)
    return run_available_now(counts)


def url_delayed_count(spark, data_dir):
    """Rows arrive up to an hour out of order, which the watermark's delay covers."""
    arrival = F.col("ms") + F.pmod(F.col(ID) * 7_919_000, F.lit(HOUR))
    events = sources.click_events(spark, data_dir).withColumn("arrival", arrival)
    clicks = _replayed(events, "arrival", {"ms": END_MS, "arrival": END_MS})()
    counts = streaming.windowed_counts(clicks, ["url"], HOUR, delay_ms=HOUR)
    return run_available_now(counts)


def url_topn(spark, data_dir, n=3):
    counts = streaming.windowed_counts(_clicks(spark, data_dir), ["url"], 2 * HOUR, HOUR)
    ranked = run_available_now(counts, per_batch=streaming.top_windows(n))
    return ranked.select("window_end", "rank", "url", "cnt")


def url_topn_all(spark, data_dir):
    return url_topn(spark, data_dir, n=2)


def window_join(spark, data_dir):
    events = Clicks(spark, data_dir)
    clicks, purchases = events.of_url("click", "click_id"), events.of_url("purchase", "purchase_id")
    pairs = streaming.window_join(clicks, purchases, "user_id", DAY)
    pairs = pairs.select("user_id", "window_start", "click_id", "purchase_id")
    return run_available_now(pairs)


def _cogroup(spark, data_dir, join):
    events = Clicks(spark, data_dir)
    clicks, purchases = events.of_url("click", "left_id"), events.of_url("purchase", "right_id")
    purchases = purchases.withColumn("right_val", F.col("right_id"))
    grouped = join(clicks, purchases, "user_id", "right_val", -1, "right_id", DAY)
    left_id = F.coalesce("left_id", F.lit(-1)).alias("left_id")
    grouped = grouped.select("user_id", "window_start", left_id, "right_val")
    return run_available_now(grouped)


def cogroup_left_join(spark, data_dir):
    return _cogroup(spark, data_dir, streaming.cogroup_left_join)


def cogroup_full_join(spark, data_dir):
    return _cogroup(spark, data_dir, streaming.cogroup_full_join)


def interval_join(spark, data_dir):
    events = Clicks(spark, data_dir)
    clicks, purchases = events.of_url("click", "click_id"), events.of_url("purchase", "purchase_id")
    pairs = streaming.interval_join(purchases, clicks, "user_id", 5 * HOUR, 10 * HOUR)
    return run_available_now(pairs.select("user_id", "purchase_id", "click_id"))


def two_stream_join(spark, data_dir, within_ms=None):
    events = Clicks(spark, data_dir)
    signups, errors = events.of_url("signup", "left_id"), events.of_url("error", "right_id")
    pairs = streaming.two_stream_join(signups, errors, "user_id", within_ms=within_ms)
    return run_available_now(pairs.select("user_id", "left_id", "right_id"))


def two_stream_join_within(spark, data_dir):
    return two_stream_join(spark, data_dir, within_ms=DAY)


def _replayed(df, order, end):
    """Rows that Spark derives, written once; a function that replays them in order."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_dir(spark, "replayed")
    df.write.parquet(path)
    delete_at_end(spark, path)
    cuts = sources.range_cuts(spark.read.schema(schema).parquet(path), order)
    return lambda: sources.replay(spark, path, schema, order, end, cuts)


def two_stream_join_salted(spark, data_dir, salts=8):
    """Users with over a fiftieth of all rows are dealt out; there are at most 50."""
    events = sources.click_events(spark, data_dir)
    per_user = events.groupBy("user_id").count()
    many = per_user.filter(F.col("count") * 50 > F.lit(events.count())).select("user_id").collect()
    streams = Clicks(spark, data_dir)
    signups, errors = streams.of_url("signup", "left_id"), streams.of_url("error", "right_id")
    hot = F.col("user_id").isin([r.user_id for r in many])
    pairs = streaming.two_stream_join(signups, errors, "user_id", hot=hot, salts=salts)
    return run_available_now(pairs.select("user_id", "left_id", "right_id"))


def _order_streams(spark, data_dir, orders=lambda side: side):
    """Both kinds of orders as a stream each; ranges in common keep them in step."""
    events = sources.click_events(spark, data_dir)
    app, third = orders(sources.app_orders(events)), orders(sources.third_orders(events))
    both = _replayed(third.unionByName(app, allowMissingColumns=True), "ts_ms", {"ts_ms": END_MS})
    return [both().filter((F.col("platform") == name) | F.col(END)) for name in ("app", "third")]


def bill_check(spark, data_dir):
    app, third = _order_streams(spark, data_dir)
    return run_available_now(streaming.bill_check(app, third, 6 * HOUR))


def bill_check_repeated(spark, data_dir):
    app, third = _order_streams(spark, data_dir, again)
    return run_available_now(streaming.bill_check_repeated(app, third, 6 * HOUR))


def pattern_match(spark, data_dir):
    events = sources.click_events(spark, data_dir)
    rules = written(action_patterns(events), "patterns")  # a few rows, read in every micro-batch
    actions = pick(_clicks(spark, data_dir), "user_id", ID, "ms", F.col("url").alias("action"))
    matched = run_available_now(
        streaming.previous_actions(actions),
        per_batch=streaming.pattern_matches(lambda: rules),
        keep_batch=True,
    )
    return matched.select("user_id", ID, "action1", "action2")


def pattern_control(spark, data_dir):
    """The patterns come as a stream of their own."""
    rules = _replayed(action_patterns(sources.click_events(spark, data_dir)), "ms", {"ms": END_MS})
    actions = pick(_clicks(spark, data_dir), "user_id", ID, "ms", F.col("url").alias("action"))
    return run_available_now(streaming.controlled_matches(actions, rules()))


def periodic_pv(spark, data_dir):
    counts = streaming.periodic_counts(_clicks(spark, data_dir), ["user_id"], 6 * HOUR)
    return run_available_now(counts)


def avg_ts_every_n(spark, data_dir):
    means = streaming.average_every_n(_clicks(spark, data_dir), ["user_id"], 5)
    return run_available_now(means)


def buffered_rows(spark, data_dir):
    events = Clicks(spark, data_dir, ID, end=False).stream()
    sharded = events.select((F.col("user_id") % 4).alias("shard"), ID)
    return run_available_now(streaming.full_chunks(sharded))


def buffered_rows_dealt(spark, data_dir):
    events = Clicks(spark, data_dir, ID, end=False).stream()
    sharded = events.select((F.col("user_id") % 4).alias("shard"), ID)
    return streaming.dealt_chunks(sharded, drain=True)


def event_timer_trace(spark, data_dir):
    """The watermark that rows meet depends on the micro-batches, which are five days here."""
    events = sources.click_events(spark, data_dir)
    first, last = events.agg(F.min("ms"), F.max("ms")).first()
    cuts = [1000 * ms for ms in range(first - first % (5 * DAY), last + 5 * DAY, 5 * DAY)] if events.take(1) else None
    clicks = Clicks(spark, data_dir, cuts=cuts).stream(ranges_per_batch=1)
    return run_available_now(streaming.event_timer_trace(clicks))


def route_alerts(spark, data_dir):
    routed = ops.route_alerts(
        without_end(_clicks(spark, data_dir)), ["click", "purchase"],
        by="url", name="user_id", url="url", ms="ms",
    )
    routes = run_available_now(routed.select(ID, "route", "message"), partition_by=["route"])
    return routes.select(ID, "route", "message")


def split_by_user(spark, data_dir):
    routed = ops.split_by_user(
        without_end(_clicks(spark, data_dir)), {1: "user-1", 2: "user-2"}, user="user_id"
    )
    routes = run_available_now(
        routed.select("route", "user_id", "url", "ms"), partition_by=["route"]
    )
    return routes.select("route", "user_id", "url", "ms")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_word_count": word_count,
    "stream_running_word_count": running_word_count,
    "stream_url_tumbling_count": url_tumbling_count,
    "stream_url_delayed_count": url_delayed_count,
    "stream_url_topn": url_topn,
    "stream_url_topn_all": url_topn_all,
    "stream_window_join": window_join,
    "stream_cogroup_left_join": cogroup_left_join,
    "stream_cogroup_full_join": cogroup_full_join,
    "stream_interval_join": interval_join,
    "stream_two_stream_join": two_stream_join,
    "stream_two_stream_join_within": two_stream_join_within,
    "stream_two_stream_join_salted": two_stream_join_salted,
    "stream_bill_check": bill_check,
    "stream_bill_check_repeated": bill_check_repeated,
    "stream_pattern_match": pattern_match,
    "stream_pattern_control": pattern_control,
    "stream_periodic_pv": periodic_pv,
    "stream_avg_ts_every_n": avg_ts_every_n,
    "stream_buffered_rows": buffered_rows,
    "stream_buffered_rows_dealt": buffered_rows_dealt,
    "stream_event_timer_trace": event_timer_trace,
    "stream_route_alerts": route_alerts,
    "stream_split_by_user": split_by_user,
}
