"""Cut keys: wide numbers, nulls, few distinct values, and chunks that stay small."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans import ordered

SCHEMA = "k long, ms long, id long, v long"


def table(spark, times, seed=5, n=3_000):
    rng = random.Random(seed)
    ids = sorted({rng.randrange(-(1 << 62), 1 << 62) for _ in range(n)})
    data = [(1, times(rng), i, rng.randrange(100)) for i in ids]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


SHAPES = {
    "wide": lambda rng: rng.randrange(-(1 << 62), 1 << 62),
    "near 2**60": lambda rng: (1 << 60) + rng.randrange(1 << 12),
    "negative": lambda rng: -(1 << 58) + rng.randrange(1 << 56),
    "two values": lambda rng: rng.choice([7, 9]),
    "one value": lambda rng: 7,
    "mostly null": lambda rng: None if rng.random() < 0.7 else rng.randrange(50),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_cut_plan_equals_plain_plan(spark, shape):
    df = table(spark, SHAPES[shape]).persist()
    order = ["ms", "id"]

    def results(max_rows):
        totals = ordered.running_totals(df, ["k"], order, {"n": None, "s": "v"}, max_rows)
        before = ordered.previous_value(df, ["k"], order, "v", "p", max_rows)
        top = ordered.maximum_before(df, ["k"], order, "v", "m", max_rows)
        return rows(totals, "id", "n", "s"), rows(before, "id", "p"), rows(top, "id", "m")

    assert results(300) == results(10**6)
    cut = ordered.chunked(df, ["k"], order, 300)
    largest = cut.rows.groupBy(ordered.CHUNK).count().agg(F.max("count")).first()[0]
    assert largest <= 300


def test_third_column_cuts_too(spark):
    df = table(spark, SHAPES["two values"]).withColumn("move", F.lit(1)).persist()
    order = ["ms", "move", "id"]
    cut = ordered.chunked(df, ["k"], order, 300)
    assert cut.rows.groupBy(ordered.CHUNK).count().agg(F.max("count")).first()[0] <= 300
    plain = ordered.running_totals(df, ["k"], order, {"n": None}, 10**6)
    assert rows(ordered.running_totals(df, ["k"], order, {"n": None}, 300), "id", "n") == rows(plain, "id", "n")


def test_strings_cut_too(spark):
    df = table(spark, SHAPES["two values"]).withColumn("name", F.concat(F.lit("n"), "id")).persist()
    order = ["ms", "name"]
    plain = ordered.running_totals(df, ["k"], order, {"n": None}, 10**6)
    cut = ordered.running_totals(df, ["k"], order, {"n": None}, 300)
    assert rows(cut, "id", "n") == rows(plain, "id", "n")


def test_cuts_are_neither_collected_nor_in_the_plan(spark):
    df = table(spark, SHAPES["wide"]).persist()
    cut = ordered.running_totals(df, ["k"], ["ms", "id"], {"n": None}, 30)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
    few = ordered.running_totals(df, ["k"], ["ms", "id"], {"n": None}, 300)
    assert abs(len(plan) - len(few._jdf.queryExecution().optimizedPlan().toString())) < 200
