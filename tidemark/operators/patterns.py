"""Matching of consecutive actions against a changing pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordered import MAX_ROWS, maximum_before, previous_value

# Up to this many pattern changes are broadcast.
MAX_BROADCAST_PATTERNS = 10_000
END_OF_TIME = 2**63 - 1


def pattern_intervals(patterns: DataFrame, ms: str = "ms") -> DataFrame:
    """``action1, action2, from_ms, to_ms``: each pattern until the next replaces it.

    For short pattern tables; of patterns with the same time the greatest stays.
    """
    w = Window.orderBy(ms, "action1", "action2")
    return patterns.select(
        "action1",
        "action2",
        F.col(ms).alias("from_ms"),
        F.lead(ms, 1, END_OF_TIME).over(w).alias("to_ms"),
    )


def join_intervals(moves: DataFrame, intervals: DataFrame, ms: str = "ms") -> DataFrame:
    """Moves whose (``prev_action``, ``action``) is the pattern in force at ``ms``."""
    in_force = (
        (F.col("prev_action") == F.col("action1"))
        & (F.col("action") == F.col("action2"))
        & (F.col(ms) >= F.col("from_ms"))
        & (F.col(ms) < F.col("to_ms"))
    )
    return moves.join(F.broadcast(intervals), in_force).drop("from_ms", "to_ms")


def is_short(patterns: DataFrame, max_broadcast: int = MAX_BROADCAST_PATTERNS) -> bool:
    """Whether the pattern table is small enough to broadcast."""
    return patterns.limit(max_broadcast + 1).count() <= max_broadcast


def match_moves(
    moves: DataFrame,
    patterns: DataFrame,
    user: str = "user_id",
    tie: str = "event_id",
    max_rows: int = MAX_ROWS,
    max_broadcast: int = MAX_BROADCAST_PATTERNS,
) -> DataFrame:
    """``user, event, action1, action2`` of the moves (``prev_action`` to ``action``)
    that equal the pattern in force at their time.

    A short pattern table is broadcast as validity intervals. A longer one is laid
    along one time line with the moves, and the latest pattern carried forward.
    """
    moves = moves.filter(F.col("prev_action").isNotNull())
    if is_short(patterns, max_broadcast):
        matched = join_intervals(moves, pattern_intervals(patterns))
    else:
        changes = patterns.select("ms", F.struct("ms", "action1", "action2").alias("_change"))
        line = moves.withColumn("_move", F.lit(1)).unionByName(
            changes.withColumn("_move", F.lit(0)), allowMissingColumns=True
        )
        seen = maximum_before(line, [], ["ms", "_move", tie], "_change", "_latest", max_rows)
        matched = seen.filter(F.col("_move") == 1).select(
            "*", F.col("_latest.action1").alias("action1"), F.col("_latest.action2").alias("action2")
        )
        matched = matched.filter(
            (F.col("prev_action") == F.col("action1")) & (F.col("action") == F.col("action2"))
        )
    return matched.select(user, tie, "action1", "action2")


def match_patterns(
    actions: DataFrame,
    patterns: DataFrame,
    user: str = "user_id",
    tie: str = "event_id",
    max_rows: int = MAX_ROWS,
    max_broadcast: int = MAX_BROADCAST_PATTERNS,
) -> DataFrame:
    """``user, event, action1, action2`` where a user's last two actions equal the
    pattern in force at the second one."""
    moves = previous_value(actions, [user], ["ms", tie], "action", "prev_action", max_rows)
    return match_moves(moves, patterns, user, tie, max_rows, max_broadcast)
