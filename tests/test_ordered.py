"""Ordered computations with keys cut into chunks equal the sequential result."""

import random

import pytest

from conftest import rows
from models import cycles
from tidemark import operators as ops
from tidemark.plans import ordered

SCHEMA = "k long, ms long, id long, v long"


def uneven(seed=3):
    """A key with most rows, a missing key, small keys, and one time that repeats."""
    rng = random.Random(seed)
    made = []
    for key, n in ((1, 500), (None, 60), (2, 40), (3, 1), (4, 7)):
        ms = 0
        for _ in range(n):
            ms += rng.choice([0, 1, 3, 1000, 4000, 9000])
            made.append((key, ms, len(made), rng.randrange(100)))
    made += [(1, 500_000, len(made) + i, i) for i in range(200)]
    rng.shuffle(made)
    return made


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.fixture(scope="module")
def data():
    return uneven()


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5).persist()


LIMITS = pytest.mark.parametrize("max_rows", [10**6, 20])


@LIMITS
def test_running_totals(frame, data, max_rows):
    got = rows(
        ordered.running_totals(frame, ["k"], ["ms", "id"], {"n": None, "s": "v"}, max_rows),
        "id", "n", "s",
    )
    expected = []
    for group in by_key(data).values():
        total = 0
        for i, row in enumerate(group, 1):
            total += row[3]
            expected.append((row[2], i, total))
    assert got == sorted(expected, key=repr)


@LIMITS
def test_previous_value(frame, data, max_rows):
    got = rows(ordered.previous_value(frame, ["k"], ["ms", "id"], "v", "p", max_rows), "id", "p")
    expected = [
        (row[2], before[3] if before else None)
        for group in by_key(data).values()
        for before, row in zip([None, *group], group)
    ]
    assert got == sorted(expected, key=repr)


@LIMITS
@pytest.mark.parametrize("keys", [["k"], []])
def test_maximum_before(frame, data, max_rows, keys):
    got = rows(ordered.maximum_before(frame, keys, ["id"], "ms", "m", max_rows), "id", "m")
    groups = {}
    for row in sorted(data, key=lambda r: r[2]):
        groups.setdefault(row[0] if keys else 0, []).append(row)
    expected = []
    for group in groups.values():
        top = None
        for row in group:
            expected.append((row[2], top))
            top = row[1] if top is None else max(top, row[1])
    assert got == sorted(expected, key=repr)


def test_chunks_are_bounded_and_ordered(frame):
    cut = ordered.chunked(frame, ["k"], ["ms", "id"], 50)
    assert cut.split
    chunks = {}
    for r in cut.rows.collect():
        chunks.setdefault((r.k, r[ordered.CHUNK]), []).append((r.ms, r.id))
    assert max(len(places) for places in chunks.values()) <= 50
    for key in (1, None):
        spans = [
            (min(p), max(p)) for (k, _), p in sorted(chunks.items(), key=lambda c: c[0][1]) if k == key
        ]
        assert len(spans) > 1
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_many_large_keys_stay_off_the_driver(frame, data, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_LISTED_KEYS", 1)
    got = rows(ordered.running_totals(frame, ["k"], ["ms", "id"], {"n": None}, 7), "id", "n")
    expected = [(r[2], i) for g in by_key(data).values() for i, r in enumerate(g, 1)]
    assert got == sorted(expected, key=repr)


@LIMITS
@pytest.mark.parametrize("period", [10, 10_000, 3_000_000])
def test_periodic_counts(frame, data, max_rows, period):
    got = rows(ops.periodic_counts(frame, ["k"], period, max_rows=max_rows))
    expected = [
        (key, *cycle)
        for key, group in by_key(data).items()
        for cycle in cycles([r[1] for r in group], period)
    ]
    assert got == sorted(expected, key=repr)


@LIMITS
def test_average_every_n(frame, data, max_rows):
    got = rows(ops.average_every_n(frame, ["k"], 5, tie="id", max_rows=max_rows))
    expected = []
    for key, group in by_key(data).items():
        total = 0
        for i, row in enumerate(group, 1):
            total += row[1]
            if i % 5 == 0:
                expected.append((key, i, total // i))
    assert got == sorted(expected, key=repr)


@LIMITS
def test_buffers(frame, data, max_rows):
    expected_rows, expected_chunks = [], []
    for key, group in by_key(data).items():
        for c in range(len(group) // 10):
            part = group[10 * c : 10 * c + 10]
            expected_rows += [(key, c, r[2]) for r in part]
            expected_chunks.append((key, c, 10, part[0][2], part[-1][2]))
    got = rows(ops.full_chunks(frame, "k", ["ms", "id"], 10, max_rows), "k", "chunk", "id")
    assert got == sorted(expected_rows, key=repr)
    got = rows(ops.chunk_summaries(frame, "k", ["ms", "id"], 10, max_rows))
    assert got == sorted(expected_chunks, key=repr)


def test_long_sums_do_not_overflow(spark):
    big = 2**62
    df = spark.createDataFrame([(1, big, i) for i in range(10)], "k long, ms long, event_id long")
    assert rows(ops.average_every_n(df, ["k"])) == [(1, 10, big), (1, 5, big)]


def test_means_go_towards_zero(spark):
    times = [-7, -6, -5, 3, 2**50 + 1, -(2**51), 12, -1, 0, -9]
    df = spark.createDataFrame(
        [(1, ms, i) for i, ms in enumerate(times)], "k long, ms long, event_id long"
    )
    got = {r[1]: r[2] for r in rows(ops.average_every_n(df, ["k"], 1))}
    times.sort()
    sums = [sum(times[:i]) for i in range(1, len(times) + 1)]
    assert got == {i: abs(s) // i * (1 if s >= 0 else -1) for i, s in enumerate(sums, 1)}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA).withColumnRenamed("id", "event_id")
    assert rows(ops.periodic_counts(empty, ["k"])) == []
    assert rows(ops.average_every_n(empty, ["k"])) == []
    assert rows(ops.watermark_trace(empty, ["event_id"])) == []
    assert rows(ops.chunk_summaries(empty, "k")) == []
