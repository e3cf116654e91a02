"""Rendezvous hashing of record keys over weighted shards, in SQL functions only.

Each key draws one pseudo-random number per shard; the shard with the smallest
weighted draw takes the record. A shard's share is its weight, a new shard takes
records only into itself, and a removed one gives up only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a shard are numbered in so many independent pieces, so no task sorts a shard.
PIECES = 1024
_DRAW_BITS = 48


def _digits(text: Column) -> Column:
    """The first 48 bits of the md5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, _DRAW_BITS // 4), 16, 10).cast("bigint")


def weighted_draw(key: Column, shard: Column, weight: Column) -> Column:
    """An exponential draw with rate ``weight``; the smallest of a key's draws wins."""
    number = _digits(F.concat(key, F.lit("#"), shard.cast("string")))
    return -F.log((number.cast("double") + 0.5) / F.lit(float(1 << _DRAW_BITS))) / weight


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a string key among ``len(weights)`` shards; weight 0 gets nothing."""
    listed = [
        F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not listed:
        raise ValueError("at least one shard needs a weight above 0")
    draws = F.transform(
        F.array(*listed),
        lambda s: F.struct(
            weighted_draw(key, s["shard"], s["weight"]).alias("draw"), s["shard"].alias("shard")
        ),
    )
    return F.array_min(draws)["shard"]


def shard_records(
    df: DataFrame, key: str, weights: Sequence[float], grown_weights: Sequence[float] | None = None
) -> DataFrame:
    """Adds ``shard`` and, for the shard list after a change, ``grown_shard``.

    The key decides alone: equal keys share a shard, a null key counts as the word
    ``null`` marked apart, and repeated rows go where the first went. An empty table
    stays empty; other columns are kept, save that ``shard`` and ``grown_shard`` are
    replaced.
    """
    text = F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")), F.lit("null"))
    sharded = df.withColumn("shard", rendezvous_shard(text, weights))
    if grown_weights is None:
        return sharded
    same = list(grown_weights[: len(weights)]) == list(weights)
    if same and len(grown_weights) == len(weights) + 1 and grown_weights[-1] > 0:
        new = len(weights)  # only the new shard can win a record over
        old_weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("shard") + 1)
        wins = weighted_draw(text, F.lit(new), F.lit(float(grown_weights[-1]))) < weighted_draw(
            text, F.col("shard"), old_weight
        )
        return sharded.withColumn("grown_shard", F.when(wins, new).otherwise(F.col("shard")))
    return sharded.withColumn("grown_shard", rendezvous_shard(text, grown_weights))


def number_slots(df: DataFrame, order: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, … without gaps within each ``shard``.

    A shard is cut into ``pieces`` by a hash of the order columns. Each piece is
    numbered alone and starts where the counts of the pieces before it end; those
    counts (``pieces`` times the number of shards) are all that is gathered. Rows equal
    in all order columns are interchangeable.
    """
    piece = F.pmod(
        _digits(F.concat_ws("#", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in order))),
        F.lit(pieces),
    ).cast("int")
    cut = df.withColumn("__tm_piece", piece)
    counts = cut.groupBy("shard", "__tm_piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__tm_piece")
    starts = counts.select(
        F.col("shard"), "__tm_piece", (F.sum("n").over(before) - F.col("n")).alias("__tm_start")
    )
    within = Window.partitionBy("shard", "__tm_piece").orderBy(*order)
    numbered = cut.withColumn("__tm_rank", F.row_number().over(within).cast("bigint"))
    # at most pieces x shards rows, 16 bytes each
    joined = numbered.join(F.broadcast(starts), ["shard", "__tm_piece"])
    return joined.withColumn("slot", F.col("__tm_rank") - 1 + F.col("__tm_start")).drop(
        "__tm_piece", "__tm_rank", "__tm_start"
    )
