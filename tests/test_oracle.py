"""Every registered query agrees with its SQL, run on whole tables."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from conftest import ROOT
from oracle_check import duck, duck_result, spark_result, type_names
from tidemark import operators as ops
from tidemark import sources
from tidemark.oracle import ORACLE as SQL
from tidemark.queries import HOUR, ID, QUERIES, action_patterns
from tidemark.stream_queries import STREAM_QUERIES

TABLES, STREAMED = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
REGISTERED = {**QUERIES, **STREAM_QUERIES}


@pytest.fixture(scope="module")
def connections():
    return {path: duck(path) for path in (TABLES, STREAMED)}


def test_every_query_has_sql():
    assert set(SQL) == set(REGISTERED)
    assert set(REGISTERED) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["window_end", "rank", "url", "cnt"]


@pytest.mark.parametrize("name", REGISTERED)
def test_query(spark, connections, name):
    data_dir = STREAMED if name.startswith("stream_") else TABLES
    df = REGISTERED[name](spark, data_dir)
    connection = connections[data_dir]
    ours, theirs = type_names(df, connection.sql(SQL[name]))
    assert ours == theirs
    assert spark_result(df) == duck_result(connection, SQL[name])


def test_event_queries_do_without_text_dependencies():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), 'op1_toxicity' in e.queries())"
    ran = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == [str(len(REGISTERED)), "False"]


def _actions(events):
    return events.select("user_id", ID, "ms", F.col("url").alias("action"))


def _shards(events):
    return events.select((F.col("user_id") % 4).alias("shard"), ID)


# The same results where hardly any key fits into one task.
CUT = {
    "running_word_count": lambda s: ops.running_word_count(
        ops.document_words(sources.documents(s, TABLES)), max_rows=2_000
    ),
    "periodic_pv": lambda s: ops.periodic_counts(
        sources.click_events(s, TABLES), ["user_id"], 6 * HOUR, max_rows=60
    ),
    "avg_ts_every_n": lambda s: ops.average_every_n(
        sources.click_events(s, TABLES), ["user_id"], 5, max_rows=60
    ),
    "pattern_match": lambda s: ops.match_patterns(
        _actions(sources.click_events(s, TABLES)),
        action_patterns(sources.click_events(s, TABLES)),
        max_rows=60,
        max_broadcast=0,
    ),
    "buffered_chunks": lambda s: ops.chunk_summaries(
        _shards(sources.click_events(s, TABLES)), max_rows=300
    ),
    "buffered_rows": lambda s: ops.full_chunks(
        _shards(sources.click_events(s, TABLES)), max_rows=300
    ),
    "bill_check": lambda s: ops.bill_check(
        sources.app_orders(sources.click_events(s, TABLES), max_rows=12),
        sources.third_orders(sources.click_events(s, TABLES), max_rows=12),
        6 * HOUR,
    ),
}


@pytest.mark.parametrize("name", CUT)
def test_query_with_cut_keys(spark, connections, name):
    assert spark_result(CUT[name](spark)) == duck_result(connections[TABLES], SQL[name])
