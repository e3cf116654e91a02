"""Control streams, dealt buffers, salted joins and running totals in any batch layout."""

import random

import pytest
from pyspark.sql import functions as F

import models
from conftest import add_file, rows
from tidemark import operators as ops
from tidemark import streaming
from tidemark.plans.bills import Halves
from tidemark.sinks import run_available_now
from tidemark.sources import table_stream

FAR = 4_000_000_000_000
ACTIONS = "user_id long, event_id long, ms long, action string"
PATTERNS = "action1 string, action2 string, ms long"


def batches(items, n, rng):
    """The items in order, as n batches of any sizes."""
    cuts = sorted(rng.choices(range(len(items) + 1), k=n - 1))
    return [items[a:b] for a, b in zip([0, *cuts], [*cuts, len(items)])]


def followed(actions, patterns):
    last, out = {}, []
    for ms, at, user, action in sorted((ms, at, user, action) for user, at, ms, action in actions):
        rule = max((p for p in patterns if p[2] <= ms), key=lambda p: p[2], default=None)
        if rule and (last.get(user), action) == rule[:2]:
            out.append((user, at, *rule[:2]))
        last[user] = action
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_control_stream_in_any_layout(make_stream, seed):
    rng = random.Random(seed)
    actions = [(rng.randrange(4), i, 1000 + 10 * i, rng.choice("abc")) for i in range(120)]
    patterns = [(rng.choice("abc"), rng.choice("abc"), ms) for ms in (1005, 1300, 1310, 1700, 2100)]
    moves = [*batches(actions, 5, rng), [(99, 10**6, FAR, "z")]]
    rules = [*batches(patterns, 5, rng), [("z", "z", FAR)]]
    left, right = make_stream(moves, ACTIONS), make_stream(rules, PATTERNS)
    got = run_available_now(streaming.controlled_matches(left, right, shards=3))
    assert rows(got, "user_id", "event_id", "action1", "action2") == sorted(followed(actions, patterns), key=repr)


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_dealt_buffers_equal_the_table(spark, make_stream, max_rows):
    rng = random.Random(7)
    data = [(rng.choice([0, 0, 0, 0, 1, None]), i, f"n{i}") for i in range(230)]
    stream = make_stream(batches(data, 4, rng), "shard long, event_id long, note string")
    got = streaming.dealt_chunks(stream, size=10, max_rows=max_rows)
    full = {}
    for shard, i, note in data:
        full.setdefault(shard, []).append((i, note))
    want = [
        (shard, n // 10, *row) for shard, held in full.items() for n, row in enumerate(held) if n < len(held) // 10 * 10
    ]
    assert rows(got, "shard", "chunk", "event_id", "note") == sorted(want, key=repr)


def test_dealt_buffers_go_on_from_their_checkpoint(spark, make_stream, tmp_path):
    schema = "shard long, event_id long"
    make_stream([[(1, i) for i in range(7)], [(1, i) for i in range(7, 12)]], schema)
    (folder,) = make_stream.folders
    where = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}

    def run():
        return rows(streaming.dealt_chunks(table_stream(spark, str(folder), schema, 1), size=5, **where), "chunk", "event_id")

    assert run() == sorted([(i // 5, i) for i in range(10)], key=repr)
    add_file(spark, folder, 2, [(1, i) for i in range(12, 21)], schema)
    assert run() == sorted([(i // 5, i) for i in range(20)], key=repr)


@pytest.mark.parametrize("within", [None, 50])
def test_salted_join_deals_a_hot_key(spark, make_stream, within):
    rng = random.Random(3)
    keys = [0, 0, 0, 1, 2, None]
    lefts = [(rng.choice(keys), i, rng.randrange(300)) for i in range(60)]
    rights = [(rng.choice(keys), i, rng.randrange(300)) for i in range(40)]
    schema = "k long, {} long, ms long"

    def joined(salts):
        left = make_stream([lefts], schema.format("l"))
        right = make_stream([rights], schema.format("r"))
        pairs = streaming.two_stream_join(left, right, "k", within, hot=F.col("k") == 0, salts=salts)
        return run_available_now(pairs.select("k", "l", "r", F.spark_partition_id().alias("part")), partitions=8)

    want = [
        (k, i, j)
        for k, i, a in lefts
        for q, j, b in rights
        if k is not None and k == q and (within is None or abs(a - b) <= within)
    ]
    plain, dealt = joined(1), joined(16)
    assert rows(plain, "k", "l", "r") == rows(dealt, "k", "l", "r") == sorted(want, key=repr)
    parts = [df.filter("k = 0").select("part").distinct().count() for df in (plain, dealt)]
    if within is None:
        assert parts[0] == 1
    assert parts[1] >= 5


def test_running_totals_in_any_layout(spark, make_stream, tmp_path):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "a", "b", None])) for i in range(90)]
    schema = "id long, word string"
    make_stream(batches(data, 4, rng), schema)
    (folder,) = make_stream.folders
    where = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}

    def run():
        stream = table_stream(spark, str(folder), schema, 1)
        return rows(streaming.running_totals(stream, ["word"], ["id"], "n", max_rows=15, **where), "id", "word", "n")

    def want(items):
        seen, out = {}, []
        for i, word in items:
            seen[word] = seen.get(word, 0) + 1
            out.append((i, word, seen[word]))
        return sorted(out, key=repr)

    assert run() == want(data)
    more = [(i, "a") for i in range(90, 99)]
    add_file(spark, folder, 4, more, schema)
    assert run() == want([*data, *more])


@pytest.mark.parametrize("max_rows", [10**6, 10])
def test_bill_check_over_repeated_ids(spark, max_rows):
    rng = random.Random(11)
    halves = [
        (f"o{rng.randrange(4)}", rng.randrange(2_000), rng.randrange(2), rng.choice(["success", "fail", None]))
        for _ in range(160)
    ]
    app = [(o, ms) for o, ms, side, _ in halves if side == 0]
    third = [(o, s, ms) for o, ms, side, s in halves if side == 1]
    got = ops.bill_check_repeated(
        spark.createDataFrame([*app, (None, 5), ("o1", None)], "order_id string, ts_ms long"),
        spark.createDataFrame([*third, (None, "success", 6), (None, "success", 7)], "order_id string, status string, ts_ms long"),
        30,
        max_rows,
    )
    want = []
    for order in sorted({o for o, *_ in halves}):
        entries = sorted((ms, side, (s or "") if side else "") for o, ms, side, s in halves if o == order)
        want += [(order, *x) for x in models.bill_check(entries, 30)]
    assert rows(got) == sorted(want, key=repr)


def test_null_orders_take_no_part(spark):
    app = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "order_id string, ts_ms long")
    third = spark.createDataFrame([(None, "success", 1), ("a", "success", 4)], "order_id string, status string, ts_ms long")
    assert rows(ops.bill_check(app, third)) == [("a", "third_matched", 4)]


def test_halves_equal_the_model():
    rng = random.Random(2)
    for _ in range(300):
        entries = sorted((rng.randrange(60), rng.randrange(2), rng.choice(["success", "fail"])) for _ in range(8))
        entries = [(ms, side, status if side else "") for ms, side, status in entries]
        halves, found = Halves(9), []
        for entry in sorted(entries):
            found += halves.row(*entry)
        assert sorted(found + halves.finish()) == models.bill_check(entries, 9)
