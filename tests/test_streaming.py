"""Streams over several micro-batches give the table results; checkpoints resume."""

import pytest
from pyspark.sql import functions as F

from conftest import add_file, rows
from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.sinks import latest_values, run_available_now
from tidemark.sources import table_stream

DATA = "/root/testdata/sf0.001"
HOUR = 3_600_000
SCHEMA = "event_id long, user_id long, url string, value double, ms long"
END = -1  # user of the far-future row that closes everything before it
FAR = 4_000_000_000_000


@pytest.fixture(scope="module")
def events(spark):
    return sources.click_events(spark, DATA).persist()


@pytest.fixture
def replay(events, make_stream):
    """The events as four files in order of time, then the far-future row."""
    collected = [tuple(r) for r in events.orderBy("ms").collect()]
    quarter = len(collected) // 4 + 1
    batches = [collected[i : i + quarter] for i in range(0, len(collected), quarter)]
    return make_stream([*batches, [(10**9, END, "end", 0.0, FAR)]], SCHEMA)


def test_sliding_counts_and_ranking(events, replay):
    expected = ops.windowed_counts(events, ["url"], 2 * HOUR, HOUR)
    counts = streaming.windowed_counts(replay, ["url"], 2 * HOUR, HOUR)
    assert rows(run_available_now(counts).filter("url <> 'end'")) == rows(expected)
    ranked = run_available_now(counts, per_batch=streaming.top_windows(3)).filter("url <> 'end'")
    columns = ["window_end", "rank", "url", "cnt"]
    assert rows(ranked, *columns) == rows(ops.top_per_group(expected, ["window_end"], 3), *columns)


def test_periodic_counts(events, replay):
    got = run_available_now(streaming.periodic_counts(replay, ["user_id"], 6 * HOUR))
    assert rows(got.filter(F.col("user_id") != END)) == rows(
        ops.periodic_counts(events, ["user_id"], 6 * HOUR)
    )


def test_average_every_n(events, replay):
    got = run_available_now(streaming.average_every_n(replay, ["user_id"], 5))
    assert rows(got) == rows(ops.average_every_n(events, ["user_id"], 5))


def test_event_timers(events, replay):
    got = run_available_now(streaming.event_timer_trace(replay)).filter(F.col("ms") < FAR)
    expected = ops.event_timer_trace(events)
    plain = F.col("kind") != "watermark"
    assert rows(got.filter(plain)) == rows(expected.filter(plain))
    # The watermark seen is the same for a whole micro-batch and never ahead of time.
    seen = got.filter(~plain)
    assert seen.filter(F.col("user_id") != END).count() == events.count()
    assert 2 <= seen.select("ms").distinct().count() <= 5


@pytest.mark.parametrize("max_broadcast", [100, 0])
def test_pattern_match(spark, events, replay, max_broadcast):
    actions = events.select("user_id", "event_id", "ms", F.col("url").alias("action"))
    middle = events.agg(F.expr("percentile(ms, 0.5)")).first()[0]
    patterns = spark.createDataFrame(
        [("view", "click", 0), ("click", "purchase", int(middle))],
        "action1 string, action2 string, ms long",
    )
    stream = replay.select("user_id", "event_id", "ms", F.col("url").alias("action"))
    got = run_available_now(
        streaming.previous_actions(stream),
        per_batch=streaming.pattern_matches(lambda: patterns, max_broadcast=max_broadcast),
        keep_batch=True,
    )
    expected = rows(ops.match_patterns(actions, patterns))
    assert expected and rows(got.drop("batch_id")) == expected


def test_full_cogroup(events, replay):
    def sides(df):
        lefts = df.filter("url in ('click', 'end')").select(
            "user_id", F.col("event_id").alias("left_id"), "ms"
        )
        rights = df.filter("url in ('purchase', 'end')").select(
            "user_id", F.col("event_id").alias("right_id"), F.col("event_id").alias("val"), "ms"
        )
        return lefts, rights

    arguments = "user_id", "val", -1, "right_id", 24 * HOUR
    columns = ["user_id", "window_start", "left_id", "val"]
    got = run_available_now(streaming.cogroup_full_join(*sides(replay), *arguments))
    expected = ops.cogroup_full_join(*sides(events), *arguments)
    assert rows(got.filter(F.col("user_id") != END), *columns) == rows(expected, *columns)


def test_running_totals_in_update_mode(events, replay):
    counts = replay.groupBy("url").agg(F.count(F.lit(1)).alias("cnt"))
    got = latest_values(run_available_now(counts, mode="update"), ["url"], "cnt")
    expected = events.groupBy("url").agg(F.count(F.lit(1)).alias("cnt"))
    assert rows(got.filter("url <> 'end'")) == rows(expected)


def test_late_rows_are_dropped(make_stream):
    # A batch drops what the watermark had passed before the batch ahead of it.
    late = [("a", 6_000), ("a", 27_000)]
    batches = [[("a", 5_000), ("a", 25_000)], [("a", 26_000)], late, [("a", 90_000)]]
    stream = make_stream(batches, "url string, ms long")
    got = run_available_now(streaming.windowed_counts(stream, ["url"]))
    assert rows(got, "window_start", "cnt") == [(0, 1), (20_000, 3)]


def test_rows_at_the_latest_time_are_kept(make_stream):
    batches = [[(1, 50)], [(1, 50)], [(1, 50)], [(1, 50), (1, 51)]]
    stream = make_stream(batches, "k long, ms long")
    got = run_available_now(streaming.average_every_n(stream, ["k"], 5, tie="ms"))
    assert rows(got) == [(1, 5, 50)]


def test_delay_keeps_rows_in_time(make_stream):
    batches = [[("a", 5_000), ("a", 12_000)], [("a", 9_500)], [("a", 90_000)]]
    stream = make_stream(batches, "url string, ms long")
    got = run_available_now(streaming.windowed_counts(stream, ["url"], delay_ms=2_000))
    assert rows(got, "window_start", "cnt") == [(0, 2), (10_000, 1)]


def test_buffer_resumes_from_its_checkpoint(spark, make_stream, tmp_path):
    schema = "shard long, event_id long, note string"

    def events(first, last):
        return [(s, i, f"n{i}") for i in range(first, last) for s in (0, 1)]

    make_stream([events(0, 7), events(7, 13)], schema)
    (folder,) = make_stream.folders
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = table_stream(spark, str(folder), schema, files_per_batch=1)
        chunks = streaming.full_chunks(stream, size=10)
        return rows(run_available_now(chunks, path=out, checkpoint=state))

    first = [(s, 0, i, f"n{i}") for s in (0, 1) for i in range(10)]
    assert run() == sorted(first, key=repr)
    add_file(spark, folder, 2, events(13, 23), schema)
    second = [(s, 1, i, f"n{i}") for s in (0, 1) for i in range(10, 20)]
    assert run() == sorted([*first, *second], key=repr)


def test_cycles_resume_from_their_checkpoint(spark, make_stream, tmp_path):
    schema = "k long, ms long"
    make_stream([[(1, 1), (1, 5_000)], [(1, 10_001)]], schema)
    (folder,) = make_stream.folders
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = table_stream(spark, str(folder), schema, files_per_batch=1)
        counts = streaming.periodic_counts(stream, ["k"])
        return rows(run_available_now(counts, path=out, checkpoint=state), "fire_ms", "pv")

    assert run() == []
    add_file(spark, folder, 2, [(1, 10_002), (1, 30_000), (2, 99_000)], schema)
    assert run() == [(10_001, 3), (20_002, 4), (40_000, 5)]


def test_settings_are_restored(spark, make_stream):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_available_now(make_stream([[(1,)]], "x long"), partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_stream_without_output_reads_back_empty(make_stream):
    got = run_available_now(make_stream([[(1,)]], "x long").filter("x > 1"))
    assert got.columns == ["x"] and rows(got) == []
