"""Registered streams over many files and micro-batches give the table results."""

import importlib
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, add_file, rows
from oracle_check import duck_result, spark_result
from tidemark import sources, streaming
from tidemark.functions import epoch_ms
from tidemark.oracle import ORACLE
from tidemark.sinks import run_available_now, run_batches, split_late
from tidemark.sources import END_MS, replay
from tidemark.stream_queries import STREAM_QUERIES

DATA = "/root/testdata/sf0.001"
replay_module = importlib.import_module("tidemark.sources.replay")


# Rows that look like ends: a negative user, the url "end", times far in the future.
ODD = [
    (100_001 + i, -1, url, f"{year}-03-01 0{i}:00:00")
    for i, (url, year) in enumerate(
        [("end", 2128), ("click", 2128), ("purchase", 2128), ("view", 2128), ("click", 2129), ("signup", 2129), ("error", 2129)]
    )
]


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The events, odd rows among them, dealt by hash over four files that each span the
    whole time, and the documents."""
    folder = tmp_path_factory.mktemp("split")
    odd = spark.createDataFrame(ODD, "event_id long, user_id long, event_type string, t string").selectExpr(
        "event_id", "cast(t as timestamp_ntz) as ts", "user_id", "event_type", "50.0d as value", "'' as props"
    )
    events = sources.event_table(spark, DATA).unionByName(odd)
    events.repartition(4, "event_id").write.parquet(f"{folder}/events.parquet")
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    documents.repartition(4, "doc_id").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def split_views(split_tables):
    connection = duckdb.connect()
    for table in ("events", "documents"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{split_tables}/{table}.parquet/*.parquet'")
    return connection


# five-day batches up to the odd rows' years would be thousands
@pytest.mark.parametrize("name", [n for n in STREAM_QUERIES if n != "stream_event_timer_trace"])
def test_stream_over_many_batches(spark, split_tables, split_views, monkeypatch, name):
    monkeypatch.setattr(replay_module, "RANGES_PER_BATCH", 1)
    got = STREAM_QUERIES[name](spark, split_tables)
    assert spark_result(got) == duck_result(split_views, ORACLE[name])


def test_late_rows_are_refused(spark, make_stream):
    stream = make_stream([[("a", 90_000)], [("a", 91_000)], [("a", 5_000)], [("a", 92_000)]], "url string, ms long")
    with pytest.raises(RuntimeError, match="1 rows"):
        run_available_now(streaming.windowed_counts(stream, ["url"]), refuse_late=True)


def test_late_rows_of_every_batch_count(spark, make_stream):
    """Spark keeps few progress reports; a late row long ago is found all the same."""
    batches = [[("a", 90_000)], [("a", 91_000)], [("a", 5_000)], *([("a", 92_000 + i)] for i in range(9))]
    stream = make_stream(batches, "url string, ms long")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        with pytest.raises(RuntimeError, match="1 rows"):
            run_available_now(streaming.windowed_counts(stream, ["url"]), refuse_late=True, partitions=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_branch(make_stream, spark, tmp_path):
    batches = [[("a", 90), ("b", 10)], [("c", 80), ("d", 79), ("e", None)], [("f", 85), ("g", 200)], [("h", 189), ("i", 190)]]
    stream = make_stream(batches, "url string, ms long")
    where = [str(tmp_path / n) for n in ("out", "state")]
    in_time, late = split_late(stream, *where, delay_ms=10)
    assert rows(late, "url") == [("d",), ("h",)]
    assert rows(in_time, "url") == [(x,) for x in "abcefgi"]
    folder = make_stream.folders[0]  # and goes on from its checkpoint
    add_file(spark, folder, 4, [("j", 100), ("k", 300)], "url string, ms long")
    _, late = split_late(sources.table_stream(spark, str(folder), "url string, ms long", 1), *where, delay_ms=10)
    assert rows(late, "url") == [("d",), ("h",), ("j",)]


def ranges_of(stream, column, checkpoint=None):
    """The smallest and largest value and the rows of every micro-batch that has rows."""
    seen = []

    def look(batch, i):
        seen.append(tuple(batch.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()))

    run_batches(stream, look, checkpoint, drain=True)
    return [s for s in seen if s[2]]


def test_ranges_rise_and_hold_every_row(spark, tmp_path):
    numbers = spark.range(1000).select((F.col("id") * 7919 % 500 - 100).alias("n"), F.col("id").alias("row"))
    numbers = numbers.unionByName(spark.createDataFrame([(None, -1)], "n long, row long"))
    path = str(tmp_path / "numbers")
    numbers.repartition(3).write.parquet(path)
    schema = numbers.schema
    for step, cuts in ((1, None), (3, None), (1, [-100, 0, 7, 400])):
        found = ranges_of(replay(spark, path, schema, "n", cuts=cuts, ranges_per_batch=step), "n")
        assert sum(n for *_, n in found) == 1000 and len(found) > 1
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_replay_goes_on_from_its_checkpoint(spark, tmp_path):
    path, checkpoint = str(tmp_path / "numbers"), str(tmp_path / "state")
    spark.range(100).write.parquet(path)
    schema = spark.range(1).schema
    seen = []

    def stopping(batch, i):
        if len(seen) == 2:
            raise RuntimeError("lost")
        seen.append(sorted(r.id for r in batch.collect()))

    cuts = [0, 20, 40, 60, 80, 100]
    stream = replay(spark, path, schema, "id", cuts=cuts, ranges_per_batch=1)
    with pytest.raises(Exception, match="lost"):
        run_batches(stream, stopping, checkpoint, drain=True)
    again = replay(spark, path, schema, "id", cuts=cuts, ranges_per_batch=1, checkpoint=checkpoint)
    run_batches(again, lambda batch, i: seen.append(sorted(r.id for r in batch.collect())), checkpoint, drain=True)
    assert [x for batch in seen for x in batch] == list(range(100))


def test_rows_behind_the_end_are_refused(spark, tmp_path):
    path = str(tmp_path / "far")
    rows_ = spark.createDataFrame([(END_MS + 5,)], "ms long")
    rows_.write.parquet(path)
    with pytest.raises(ValueError, match="end of time"):
        replay(spark, path, rows_.schema, "ms", {"ms": END_MS})


def test_empty_table_replays_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    sources.event_table(spark, DATA).limit(0).write.parquet(f"{path}/events.parquet")
    assert STREAM_QUERIES["stream_url_tumbling_count"](spark, path).count() == 0
    assert STREAM_QUERIES["stream_event_timer_trace"](spark, path).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-11-03 05:30:00.123456", "2024-11-03 06:30:00", "2024-03-10 02:30:00.999", "1969-12-31 23:59:59.5"]
        times = spark.createDataFrame([(t,) for t in texts], "t string")
        got = times.select(epoch_ms(F.col("t").cast("timestamp_ntz")).alias("ms"))
        assert rows(got) == [(-500,), (1710037800999,), (1730611800123,), (1730615400000,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


PRINTING = """
from tidemark.session import local_session
from tidemark.sinks import show_stream

spark = local_session(2)
spark.range(2_500).repartition(3).write.parquet({path!r})
query = show_stream(spark.readStream.schema("id bigint").parquet({path!r}), "shown")
query.processAllAvailable()
query.stop()
spark.stop()
"""


def test_every_row_is_printed(tmp_path):
    # in a process of its own, whose output the executor's tasks share
    code = PRINTING.format(path=str(tmp_path / "rows"))
    ran = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    printed = re.findall(r"label=shown id=(\d+)", ran.stdout + ran.stderr)
    assert ran.returncode == 0 and sorted(map(int, printed)) == list(range(2_500))
