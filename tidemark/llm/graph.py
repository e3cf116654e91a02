"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``node, root`` for every node of ``a, b``; the root is a component's smallest node.

    Alternates large-star and small-star steps until every node points at its root,
    which takes a number of rounds that grows with the logarithm of the nodes. Links
    stay in Spark; each round is written out, so a lost executor repeats one round.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        label,
    )
    before = None
    while True:
        after = _digest(edges)
        if after == before or after[0] == 0:
            break
        before = after
        edges = stored(_small_star(_large_star(edges)), label)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod("b", F.lit(1 << 30)))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node point at the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    smallest = smallest.select("a", F.least("a", "m").alias("m"))
    moved = both.join(smallest, "a").filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point at the smallest of these."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").filter("b <> m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(smallest.select("a", F.col("m").alias("b")))
        .distinct()
    )
