"""Small literal inputs with known results, on tables and on streams.

The streamed inputs end with a far-future row per input, which moves the watermark
past everything before it and is filtered out of the result.
"""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import operators as ops
from tidemark import streaming
from tidemark.sinks import run_available_now

FAR = 10**9
NONE = "没有匹配数据"

PEOPLE = [("王五", 23, 1000), ("李四", 24, 2000), ("张三", 25, 3000)]
JOBS = [("赵二", "经理", 2000, 1), ("李四", "医生", 3000, 2), ("张三", "老师", 4000, 3)]
PERSON, JOB = "name string, age int, ms long", "name string, job string, ms long, id long"
LEFT = [("张三", 25, "老师"), ("李四", 24, "医生"), ("王五", 23, NONE)]
FULL = sorted([*LEFT, ("赵二", None, "经理")], key=repr)

ORDERS = [
    ("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
    ("Alice", "order-4", 20000), ("Cary", "order-5", 51000),
]
CLICKS = [
    ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
    ("Bob", "./prod?id=2", 2500), ("Alice", "./prod?id=300", 36000), ("Bob", "./home", 30000),
    ("Bob", "./prod?id=1", 23000), ("Bob", "./prod?id=3", 33000),
]
ORDER, CLICK = "user string, order_id string, ms long", "user string, url string, ms long"
NEAR = sorted(
    [
        ("order-2", "./prod?id=100"), ("order-2", "./prod?id=200"),
        ("order-3", "./home"), ("order-3", "./prod?id=1"),
    ]
)

STREAM1 = [("a", "stream-1", 1000), ("b", "stream-1", 2000), ("c", "stream-1", 3000)]
STREAM2 = [
    ("a", "stream-2", 3000), ("b", "stream-2", 4000), ("b", "stream-2", 4500), ("d", "stream-2", 5000)
]
PAIRS = [("a", 1000, 3000), ("b", 2000, 4000), ("b", 2000, 4500)]

APP = [("both", 1000), ("edge", 6000), ("late", 1000), ("bad", 1000), ("app-only", 2000)]
THIRD = [
    ("both", "success", 4000), ("edge", "success", 1000), ("late", "success", 6001),
    ("bad", "fail", 2000), ("third-only", "success", 3000),
]
OUTCOMES = sorted(
    [
        ("both", "third_matched", 4000), ("edge", "app_matched", 6000),
        ("late", "third_timeout", 6000), ("late", "app_timeout", 11001),
        ("bad", "payment_failed", 6000), ("app-only", "third_timeout", 7000),
        ("third-only", "app_timeout", 8000),
    ]
)
APP_ORDER, THIRD_ORDER = "order_id string, ts_ms long", "order_id string, status string, ts_ms long"

ACTIONS = [("Alice", "login", 1, 1), ("Alice", "pay", 2, 2), ("Bob", "login", 3, 3), ("Bob", "buy", 4, 4)]
ACTION, PATTERN = "user_id string, action string, ms long, event_id long", "action1 string, action2 string, ms long"
PATTERN_CASES = {
    "both before": ([("login", "pay", -2), ("login", "buy", -1)], [("Bob", "login", "buy")]),
    "in between": (
        [("login", "pay", 0), ("login", "buy", 3)],
        [("Alice", "login", "pay"), ("Bob", "login", "buy")],
    ),
    "from its own time on": ([("login", "pay", 2)], [("Alice", "login", "pay")]),
    "none yet": ([("login", "pay", 9)], []),
}


def split(data):
    return [data[:2], data[2:]]


class TestCogroup:
    def test_left(self, spark):
        people, jobs = spark.createDataFrame(PEOPLE, PERSON), spark.createDataFrame(JOBS, JOB)
        got = ops.cogroup_left_join(people, jobs, "name", "job", NONE, "id")
        assert rows(got, "name", "age", "job") == LEFT

    def test_full(self, spark):
        people, jobs = spark.createDataFrame(PEOPLE, PERSON), spark.createDataFrame(JOBS, JOB)
        got = ops.cogroup_full_join(people, jobs, "name", "job", NONE, "id")
        assert rows(got, "name", "age", "job") == FULL

    @pytest.mark.parametrize(
        "join, expected",
        [(streaming.cogroup_left_join, LEFT), (streaming.cogroup_full_join, FULL)],
    )
    def test_streams(self, make_stream, join, expected):
        people = make_stream([*split(PEOPLE), [("end", 0, FAR)]], PERSON)
        jobs = make_stream([*split(JOBS), [("end", "x", FAR, 9)]], JOB)
        got = run_available_now(join(people, jobs, "name", "job", NONE, "id"))
        assert rows(got.filter("name <> 'end'"), "name", "age", "job") == expected

    def test_last_right_value_wins(self, spark):
        people = spark.createDataFrame([("x", 1, 0), ("x", 2, 10_000)], PERSON)
        jobs = spark.createDataFrame(
            [("x", "a", 5, 1), ("x", "c", 7, 3), ("x", "b", 7, 2), ("x", "z", 10_500, 0)], JOB
        )
        got = ops.cogroup_left_join(people, jobs, "name", "job", NONE, "id")
        assert rows(got, "age", "job") == [(1, "c"), (2, "z")]

    def test_all_unmatched_right_rows_stay(self, spark):
        people = spark.createDataFrame([("x", 1, 10_000)], PERSON)
        jobs = spark.createDataFrame([("x", "a", 5, 1), ("x", "b", 7, 2)], JOB)
        got = ops.cogroup_full_join(people, jobs, "name", "job", NONE, "id")
        assert rows(got, "age", "job") == [(1, NONE), (None, "a"), (None, "b")]


class TestJoins:
    def test_interval(self, spark):
        orders, clicks = spark.createDataFrame(ORDERS, ORDER), spark.createDataFrame(CLICKS, CLICK)
        assert rows(ops.interval_join(orders, clicks, "user"), "order_id", "url") == NEAR

    def test_interval_stream(self, make_stream):
        orders = make_stream([ORDERS], ORDER)
        clicks = make_stream([CLICKS], CLICK)
        got = run_available_now(streaming.interval_join(orders, clicks, "user"))
        assert rows(got, "order_id", "url") == NEAR

    @pytest.mark.parametrize("before, after", [(0, 0), (0, 7), (7, 0), (3, 50)])
    def test_interval_bounds(self, spark, before, after):
        left = [("k", f"l{i}", ms) for i, ms in enumerate(range(-60, 60, 4))]
        right = [("k", f"r{i}", ms) for i, ms in enumerate(range(-60, 60, 3))]
        expected = sorted(
            (a[1], b[1]) for a in left for b in right if a[2] - before <= b[2] <= a[2] + after
        )
        got = ops.interval_join(
            spark.createDataFrame(left, "k string, l string, ms long"),
            spark.createDataFrame(right, "k string, r string, ms long"),
            "k", before, after,
        )
        assert rows(got, "l", "r") == expected

    def test_window(self, spark):
        left = spark.createDataFrame([("a", 1, 0), ("a", 2, 9_999), ("a", 3, 10_000)], "k string, l int, ms long")
        right = spark.createDataFrame([("a", 7, 5_000), ("b", 8, 0), ("a", 9, 19_999)], "k string, r int, ms long")
        assert rows(ops.window_join(left, right, "k"), "l", "r") == [(1, 7), (2, 7), (3, 9)]

    def test_window_stream(self, make_stream):
        left = make_stream([[("a", 1, 0)], [("a", 2, 9_999), ("a", 3, 10_000)]], "k string, l int, ms long")
        right = make_stream([[("a", 7, 5_000), ("b", 8, 0)], [("a", 9, 19_999)]], "k string, r int, ms long")
        got = run_available_now(streaming.window_join(left, right, "k"))
        assert rows(got, "l", "r", "window_start") == [(1, 7, 0), (2, 7, 0), (3, 9, 10_000)]

    def test_two_streams(self, spark, make_stream):
        schema1, schema2 = "k string, src1 string, ms long", "k string, src2 string, ms long"
        one, two = spark.createDataFrame(STREAM1, schema1), spark.createDataFrame(STREAM2, schema2)
        assert rows(ops.two_stream_join(one, two, "k"), "k", "left_ms", "right_ms") == PAIRS
        within = ops.two_stream_join(one, two, "k", within_ms=2000)
        assert rows(within, "k", "left_ms", "right_ms") == PAIRS[:2]

        one, two = make_stream(split(STREAM1), schema1), make_stream(split(STREAM2), schema2)
        got = run_available_now(streaming.two_stream_join(one, two, "k"))
        assert rows(got, "k", "left_ms", "right_ms") == PAIRS


class TestBillCheck:
    def test_table(self, spark):
        app, third = spark.createDataFrame(APP, APP_ORDER), spark.createDataFrame(THIRD, THIRD_ORDER)
        assert rows(ops.bill_check(app, third)) == OUTCOMES

    @pytest.mark.parametrize("check", [streaming.bill_check, streaming.bill_check_repeated])
    def test_streams(self, make_stream, check):
        app = make_stream([*split(sorted(APP, key=lambda r: r[1])), [("end", FAR)]], APP_ORDER)
        third = make_stream(
            [*split(sorted(THIRD, key=lambda r: r[2])), [("end2", "success", FAR)]], THIRD_ORDER
        )
        got = run_available_now(check(app, third))
        assert rows(got.filter("order_id not like 'end%'")) == OUTCOMES

    def test_repeated_order_is_refused(self, spark):
        app = spark.createDataFrame([("x", 1), ("x", 2)], APP_ORDER)
        third = spark.createDataFrame([], THIRD_ORDER)
        with pytest.raises(Exception, match="occurs twice"):
            ops.bill_check(app, third).collect()


class TestPatterns:
    @pytest.mark.parametrize("case", PATTERN_CASES)
    @pytest.mark.parametrize("max_broadcast", [100, 0])
    def test_table(self, spark, case, max_broadcast):
        patterns, expected = PATTERN_CASES[case]
        got = ops.match_patterns(
            spark.createDataFrame(ACTIONS, ACTION),
            spark.createDataFrame(patterns, PATTERN),
            max_broadcast=max_broadcast,
        )
        assert rows(got, "user_id", "action1", "action2") == expected

    def test_stream(self, spark, make_stream):
        patterns, expected = PATTERN_CASES["in between"]
        actions = make_stream([ACTIONS[:1], ACTIONS[1:3], ACTIONS[3:]], ACTION)
        got = run_available_now(
            streaming.previous_actions(actions),
            per_batch=streaming.pattern_matches(lambda: spark.createDataFrame(patterns, PATTERN)),
        )
        assert rows(got, "user_id", "action1", "action2") == expected


class TestKeyed:
    def test_periodic(self, spark):
        times = [(1, ms) for ms in (0, 5000, 10000, 10001, 30000)]
        got = ops.periodic_counts(spark.createDataFrame(times, "k long, ms long"), ["k"])
        assert [r[1:] for r in rows(got)] == [(10000, 3), (20001, 4), (40000, 5)]

    def test_average(self, spark):
        data = [("a", ms, ms) for ms in range(1, 11)]
        df = spark.createDataFrame(data, "k string, ms long, event_id long")
        assert rows(ops.average_every_n(df, ["k"])) == [("a", 10, 5), ("a", 5, 3)]

    def test_buffer(self, spark):
        df = spark.createDataFrame([(0, i) for i in range(23)], "shard long, event_id long")
        assert rows(ops.chunk_summaries(df)) == [(0, 0, 10, 0, 9), (0, 1, 10, 10, 19)]
        assert rows(ops.full_chunks(df), "event_id") == sorted(((i,) for i in range(20)), key=repr)


class TestWindows:
    CLICKS = [("a", 0), ("a", 4_999), ("b", 5_000), ("a", 9_999), ("b", 10_000), ("c", -1)]

    def test_sliding(self, spark):
        df = spark.createDataFrame(self.CLICKS, "url string, ms long")
        got = rows(ops.windowed_counts(df, ["url"], 10_000, 5_000))
        expected = {}
        for url, ms in self.CLICKS:
            for start in range(-10_000, 20_000, 5_000):
                if start <= ms < start + 10_000:
                    expected[url, start] = expected.get((url, start), 0) + 1
        assert got == sorted(((u, s, s + 10_000, n) for (u, s), n in expected.items()), key=repr)

    @pytest.mark.parametrize("size, slide", [(10, 4), (9, 6), (5, 10), (7, 7)])
    def test_any_slide(self, spark, size, slide):
        df = spark.createDataFrame([("a", ms) for ms in range(-20, 40, 3)], "url string, ms long")
        got = rows(ops.windowed_counts(df, ["url"], size, slide), "window_start", "cnt")
        expected = []
        for start in range(-10 * slide, 10 * slide, slide):
            n = sum(start <= ms < start + size for ms in range(-20, 40, 3))
            if n:
                expected.append((start, n))
        assert got == sorted(expected, key=repr)

    def test_truncated_start_goes_towards_zero(self, spark):
        df = spark.createDataFrame(self.CLICKS, "url string, ms long")
        got = rows(ops.truncated_window_counts(df, ["url"]).filter("url = 'c'"))
        assert got == [("c", 0, 10_000, 1)]

    def test_top_n_takes_what_is_there_and_breaks_ties_by_url(self, spark):
        counts = [(1, "b", 5), (1, "a", 5), (1, "c", 2**40), (2, "x", 1)]
        df = spark.createDataFrame(counts, "window_end long, url string, cnt long")
        assert rows(ops.top_per_group(df, ["window_end"], 2), "window_end", "rank", "url") == [
            (1, 1, "c"), (1, 2, "a"), (2, 1, "x"),
        ]

    def test_count_text(self, spark):
        df = spark.createDataFrame([("./home", 3)], "url string, cnt long")
        assert ops.counts_as_text(df).first().message == "Url:./home数量为:3"


class TestRouting:
    EVENTS = [("Mary", "./a", 1), ("Bob", "./b", 2), ("Cary", "./c", 3)]
    SCHEMA = "name string, url string, timestamp long"

    def test_alerts(self, spark):
        df = spark.createDataFrame(self.EVENTS, self.SCHEMA)
        text = "Event{name='%s', url='%s', timestamp=%d}"
        assert rows(ops.route_alerts(df), "route", "message") == sorted(
            [
                ("main", "检测到Mary的信息" + text % self.EVENTS[0]),
                ("main", "检测到Bob的信息" + text % self.EVENTS[1]),
                ("side", "side-output: " + text % self.EVENTS[2]),
            ],
            key=repr,
        )

    def test_branches(self, spark):
        df = spark.createDataFrame(self.EVENTS, self.SCHEMA)
        routed = ops.split_by_user(df, {"Mary": "Mary-pv", "Bob": "Bob-pv"})
        for route, event in zip(("Mary-pv", "Bob-pv", "main"), self.EVENTS):
            assert rows(ops.branch(routed, route)) == [event]

    def test_branches_of_a_stream_are_written_apart(self, spark, make_stream, tmp_path):
        stream = make_stream([self.EVENTS[:1], self.EVENTS[1:]], self.SCHEMA)
        routed = ops.split_by_user(stream, {"Mary": "Mary-pv", "Bob": "Bob-pv"})
        path = str(tmp_path / "out")
        run_available_now(routed, path=path, partition_by=["route"])
        assert rows(spark.read.parquet(f"{path}/route=Bob-pv")) == [self.EVENTS[1]]


class TestTraces:
    def test_watermark(self, spark):
        arrived = [(0, 10), (1, 30), (2, 27), (3, 5), (4, 40)]
        df = spark.createDataFrame(arrived, "at long, ms long")
        got = rows(ops.watermark_trace(df, ["at"], delay_ms=2))
        assert got == [
            (0, 10, None, False), (1, 30, 7, False), (2, 27, 27, True), (3, 5, 27, True),
            (4, 40, 27, False),
        ]

    def test_timers(self, spark):
        df = spark.createDataFrame([("a", 5, 1), ("b", 5, 2), ("a", 9, 3)], "user_id string, ms long, event_id long")
        assert rows(ops.event_timer_trace(df)) == sorted(
            [
                ("arrival", "a", 5), ("arrival", "b", 5), ("arrival", "a", 9),
                ("watermark", "a", None), ("watermark", "b", 4), ("watermark", "a", 4),
                ("timer", None, 15), ("timer", None, 19),
            ],
            key=repr,
        )
