"""The physical plans stay what they should be at scale."""

from contextlib import contextmanager, redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import operators as ops
from tidemark import queries
from tidemark.sinks import show_stream
from tidemark.sources import spread

DATA = "/root/testdata/sf0.01"


def plan(df):
    text = StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final_plan(df):
    """The plan as adapted while the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {key: key.replace("__", ".") for key in values}
    before = {key: spark.conf.get(name, None) for key, name in names.items()}
    for key, name in names.items():
        spark.conf.set(name, str(values[key]))
    try:
        yield
    finally:
        for key, name in names.items():
            if before[key] is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before[key])


@pytest.mark.parametrize("name", queries.QUERIES)
def test_aggregates_hash_and_nothing_is_crossed(spark, name):
    text = plan(queries.QUERIES[name](spark, DATA))
    for unwanted in ("SortAggregate", "CartesianProduct", "NestedLoop", "BatchEvalPython"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries.window_join(spark, DATA))
    assert "EqualTo(event_type,click)" in text and "EqualTo(event_type,purchase)" in text
    assert "props" not in text and "value" not in text.split("ReadSchema", 1)[1].split("\n")[0]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan(
        queries.url_tumbling_count(spark, DATA)
    )


def test_ranking_is_limited_before_the_shuffle(spark):
    text = plan(queries.url_topn_keyed(spark, DATA)).split("\n\n")[0]
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("route_alerts", 0),
        ("split_by_user", 0),
        ("url_tumbling_count", 1),
        ("avg_ts_every_n", 1),
        ("periodic_pv", 1),
        ("buffered_chunks", 1),
        ("bill_check", 3),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    tree = plan(queries.QUERIES[name](spark, DATA)).split("\n\n\n")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == shuffles


def test_a_window_with_most_rows_is_split(spark):
    """One key and window holds most rows; the adaptive join splits it."""
    left = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("l"),
        F.lit(5).alias("ms"),
    )
    right = spark.range(400).select(F.col("id").alias("k"), F.lit(7).alias("ms"), F.lit("x" * 50).alias("r"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__shuffle__partitions=8,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.5,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    ):
        joined = ops.window_join(left.repartition(16), right, "k")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 36_000 + 40


def test_spread_only_touches_small_inputs(spark):
    small, wide = spark.range(100).coalesce(1), spark.range(100).repartition(64)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(wide) is wide


def test_show_stream_runs(make_stream):
    query = show_stream(make_stream([[(1,)]], "x long"), "input", tasks=2)
    query.processAllAvailable()
    query.stop()
    assert query.name == "input" and query.exception() is None


def test_session_time_zone_does_not_matter(spark):
    expected = rows(queries.url_tumbling_count(spark, DATA))
    with settings(spark, spark__sql__session__timeZone="Asia/Tokyo"):
        assert rows(queries.url_tumbling_count(spark, DATA)) == expected
