"""What large micro-batches and large keys cost: rows stay packed, state is met once a user,
and words are neither joined nor written to be counted."""

import datetime
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark import operators as ops
from tidemark import streaming
from tidemark.plans import ordered
from tidemark.sinks import run_available_now
from tidemark.streaming import processors as p
from tidemark.streaming.blocks import from_block, to_block

AT = datetime.datetime(2024, 1, 1, 12, 0, 0, 123456)


class Values:
    """State of one key, which counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def _value(self, name, schema=None, *more):
        def call(work):
            self.calls += 1
            return work

        held = self.held
        maps = held.setdefault(("map", name), {})
        return SimpleNamespace(
            get=lambda: held.get(name),
            update=lambda value: held.__setitem__(name, value),
            put=lambda value: held.__setitem__(name, value),
            appendList=lambda value: held.setdefault(name, []).extend(value),
            clear=lambda: held.pop(name, None),
            containsKey=lambda key: call(key in maps),
            getValue=lambda key: call(maps.get(key)),
            updateValue=lambda key, value: call(maps.__setitem__(key, value)),
        )

    getValueState = getListState = getMapState = _value

    def registerTimer(self, due):
        pass

    deleteTimer = registerTimer


def test_buffers_of_a_large_shard_stay_packed():
    """one call may not give Spark an object for each of its rows."""
    held = T.StructType([T.StructField("id", T.LongType())])
    processor = p.FullChunkBlocks(held, ["id"], 10).named(["k", "block"])
    processor.init(Values())
    n = 300_007
    blocks = [SimpleNamespace(block=to_block(pa.table({"id": list(range(i, n, 3))}))) for i in range(3)]
    out = list(processor.handleInputRows((1,), iter(blocks), None))
    assert len(out) == 3
    got = pa.concat_tables([from_block(row.block) for row in out])
    assert got["id"].to_pylist() == list(range(300_000))
    assert got["chunk"].to_pylist() == [i // 10 for i in range(300_000)]
    out = list(processor.handleInputRows((1,), iter([SimpleNamespace(block=to_block(pa.table({"id": [n, n + 1, n + 2]})))]), None))
    assert from_block(out[0].block)["id"].to_pylist() == list(range(300_000, 300_010))


@pytest.mark.parametrize("kind", ["bigint", "struct<a:bigint>"])
def test_buffers_keep_types_nulls_and_large_numbers(spark, make_stream, kind):
    schema = f"shard {kind}, event_id bigint, at timestamp, name string, parts array<int>"
    key = (lambda k: k) if kind == "bigint" else (lambda k: None if k is None else (k,))
    first = [(key(None), 2**62 + 1, AT, None, [1, None]), (key(None), None, None, "b", None), (key(7), 5, AT, "c", [])]
    second = [(key(None), 2**62 + 3, AT, "d", [2]), (key(7), 4, None, "e", [3]), (key(None), 2**62 + 5, None, "f", None)]
    got = run_available_now(streaming.full_chunks(make_stream([first, second], schema), size=2))
    assert got.columns == ["shard", "chunk", "event_id", "at", "name", "parts"]
    got = rows(got.withColumn("shard", F.col("shard.a")) if kind != "bigint" else got)
    assert got == sorted([
        (None, 0, None, None, "b", None), (None, 0, 2**62 + 1, AT, None, [1, None]),
        (None, 1, 2**62 + 3, AT, "d", [2]), (None, 1, 2**62 + 5, None, "f", None),
        (7, 0, 5, AT, "c", []), (7, 0, 4, None, "e", [3]),
    ], key=repr)


def test_control_meets_a_users_state_once():
    """state calls follow the users, not their actions."""
    processor = p.ControlledMatch("bigint", "bigint").named(["shard", "user", "id", "action1", "action2"])
    state = Values()
    processor.init(state)
    names = ["ms", "kind", "id", "user", "action", "action1", "action2"]
    moves = [(i + 1, 1, i, i % 3 or None, "ab"[i // 3 % 2], None, None) for i in range(3000)]
    data = [SimpleNamespace(**dict(zip(names, row))) for row in [(0, 0, None, None, None, "a", "b"), *moves]]
    assert not list(processor.handleInputRows((0,), iter(data), None))
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 1500)
    found = list(processor.handleExpiredTimer((0,), mark, SimpleNamespace(getExpiryTimeInMs=lambda: 0)))
    assert [row.id for row in found] == [i for i in range(1500) if i // 3 % 2]
    assert state.calls <= 3 * 3
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 5000)
    found = list(processor.handleExpiredTimer((0,), mark, SimpleNamespace(getExpiryTimeInMs=lambda: 1501)))
    assert [row.id for row in found] == [i for i in range(1500, 3000) if i // 3 % 2]
    assert state.held["due"] == (None,) and "waiting" not in state.held


def _expected(data):
    seen, out = {}, []
    for doc, line, pos, word in sorted(data, key=lambda r: tuple((v is not None, v) for v in r[:3])):
        seen[word] = seen.get(word, 0) + 1
        out.append((doc, line, pos, word, seen[word]))
    return sorted(out, key=repr)


WORDS = "doc_id bigint, line_no int, pos int, word string"
DATA = [(None if d == 3 else d * d * d, d % 2, i, None if i % 5 == 0 else "abc"[i % 3]) for d in range(60) for i in range(20)]


def test_large_words_are_neither_joined_nor_written(spark, monkeypatch):
    """chunks follow from the rows themselves."""
    monkeypatch.setattr(ordered, "_cut", None)
    df = spark.createDataFrame(DATA, WORDS).repartition(5)
    got = ops.running_word_count(df, max_rows=50)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == _expected(DATA)


def test_one_document_with_most_words(spark):
    data = [(0, 0, i, "a") for i in range(500)] + [(2**62 + d, 0, 0, "a") for d in range(5)]
    assert rows(ops.running_word_count(spark.createDataFrame(data, WORDS), max_rows=20)) == _expected(data)


@pytest.mark.parametrize("max_rows", [10, 50, 10_000])
def test_running_totals_of_batches(spark, make_stream, max_rows, monkeypatch):
    """batches are counted on, without a join of their rows where chunks are small."""
    data = sorted((r for r in DATA if r[0] is not None), key=lambda r: r[:3])
    if max_rows == 50:
        monkeypatch.setattr(streaming.running, "_after", None)
    stream = make_stream([data[:400], data[400:430], data[430:]], WORDS)
    got = streaming.running_totals(stream, ["word"], ["doc_id", "line_no", "pos"], "running", max_rows=max_rows)
    assert rows(got) == _expected(data)
