"""Splitting of a stream into named branches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_text


def route_alerts(
    df: DataFrame,
    watched: Sequence[str] = ("Mary", "Bob"),
    by: str = "name",
    name: str = "name",
    url: str = "url",
    ms: str = "timestamp",
) -> DataFrame:
    """Add ``route`` and ``message``: watched values go to main, others to side."""
    text = event_text(F.col(name), F.col(url), F.col(ms))
    is_watched = F.col(by).isin(*watched)
    # Fixed wording.
    alert = F.concat(F.lit("检测到"), F.col(by).cast("string"), F.lit("的信息"), text)
    other = F.concat(F.lit("side-output: "), text)
    return df.withColumn("route", F.when(is_watched, "main").otherwise("side")).withColumn(
        "message", F.when(is_watched, alert).otherwise(other)
    )


def split_by_user(
    df: DataFrame, users: Mapping, user: str = "name", main: str = "main"
) -> DataFrame:
    """Add ``route``: the branch which ``users`` names for the row, else ``main``."""
    route = F.lit(main)
    for value, name in reversed(list(users.items())):
        route = F.when(F.col(user) == F.lit(value), name).otherwise(route)
    return df.withColumn("route", route)


def branch(routed: DataFrame, route: str) -> DataFrame:
    """The rows of one branch, without the route."""
    return routed.filter(F.col("route") == route).drop("route")
