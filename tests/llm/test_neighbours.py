"""Nearest neighbours: recall against brute force, exact scores, ties, odd vectors."""

import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, h1 string, list string, rank int, score string"
BY_20 = "vec_id % 20 = 0"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "c", 1, "c") for i, v in rows], SCHEMA).repartition(4)


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def grouped(df):
    found = defaultdict(list)
    for row in sorted(df.collect()):
        assert row.rank == len(found[row.query_id]) + 1
        found[row.query_id].append((row.vec_id, row.score))
    return found


def test_recall_and_scores(spark):
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()
    vectors = {r["vec_id"]: [float(x) for x in r["embedding"]] for r in rows}
    found = grouped(neighbours.nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), BY_20))
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids])
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for q, near in found.items():
        scores = matrix @ vectors[q]
        scores[ids == q] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]]) & {i for i, _ in near})
        assert len(near) == 20 and q not in {i for i, _ in near}
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(score == product(vectors[q], vectors[i]) for i, score in near)
    assert hits / (20 * len(found)) >= 0.95


@pytest.mark.parametrize("shape", ["long tails", "few directions", "unequal lengths"])
def test_recall_on_other_shapes(spark, shape):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((1500, 24))
    if shape == "long tails":
        data = rng.standard_t(3, (1500, 24))
    elif shape == "few directions":
        data = rng.standard_normal((1500, 3)) @ rng.standard_normal((3, 24))
    else:
        data *= np.exp(rng.standard_normal((1500, 1)))
    data = data.astype(np.float32).astype(float)
    found = grouped(neighbours.nearest(table(spark, enumerate(data.tolist())), BY_20))
    hits = 0
    for q, near in found.items():
        scores = data @ data[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {i for i, _ in near})
    assert hits / (20 * len(found)) >= 0.9


def test_equal_vectors_and_ties(spark):
    """A third of the rows share a vector; all of them tie and the smallest ids count."""
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 == 0 else [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(600)]
    usable = [(i, v) for i, v in rows if any(v)]
    found = grouped(neighbours.nearest(table(spark, rows), BY_20))
    for q, near in found.items():
        vector = dict(usable)[q]
        best = sorted((-product(vector, v), i) for i, v in usable if i != q)[:20]
        assert near == [(i, -s) for s, i in best]


def test_small_and_odd_tables(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0])]
    rows += [(6, [nan, 1.0]), (40, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0])]
    rows += [(10, [-1.0, 5.0]), (10, [1.0, 0.0])]  # an id with two vectors keeps the smallest
    found = grouped(neighbours.nearest(table(spark, rows), BY_20))
    assert found == {
        0: [(10, 9.0), (20, 4.0), (3, 2.0)],
        20: [(0, 4.0), (10, 3.0), (3, 1.0)],
    }
    assert neighbours.nearest(table(spark, [(0, [1.0])]), BY_20).count() == 0
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), BY_20).count() == 0
    doubles = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.7])], "vec_id bigint, embedding array<double>")
    assert grouped(neighbours.nearest(doubles, BY_20)) == {0: [(1, 0.1 * 0.3 + 0.2 * 0.7)]}


def test_parts_of_a_list(spark, monkeypatch):
    """A single list cut into many parts gives the same neighbours."""
    rng = np.random.default_rng(3)
    data = rng.standard_normal((400, 8)).astype(np.float32).astype(float)
    rows = table(spark, enumerate(data.tolist()))
    whole = grouped(neighbours.nearest(rows, BY_20, n_lists=1))
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    assert grouped(neighbours.nearest(rows, BY_20, n_lists=1)).keys() == whole.keys()
    hits = sum(
        len({i for i, _ in near} & set(np.argsort(-(data @ data[q]))[:21].tolist())) for q, near in whole.items()
    )
    assert hits >= 0.9 * 20 * len(whole)
