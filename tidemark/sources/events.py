"""Click events replayed from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_ms, pick
from tidemark.schemas import EVENTS_TABLE
from tidemark.sources.files import table_stream


def event_table(spark: SparkSession, data_dir: str, stream: bool = False) -> DataFrame:
    """The stored table, whole or as a stream of its files."""
    if stream:  # a pattern, as a stream takes no single file; it matches this name only
        return table_stream(spark, f"{data_dir}/event[s].parquet", EVENTS_TABLE)
    return spark.read.schema(EVENTS_TABLE).parquet(f"{data_dir}/events.parquet")


def click_events(spark: SparkSession, data_dir: str, stream: bool = False) -> DataFrame:
    """Events as ``event_id, user_id, url, value, ms``."""
    return clicks_of(event_table(spark, data_dir, stream))


def clicks_of(events: DataFrame) -> DataFrame:
    """The click events among rows of the stored table, whole or a stream."""
    return pick(
        events,
        "event_id",
        "user_id",
        F.col("event_type").alias("url"),
        "value",
        epoch_ms(F.col("ts")).alias("ms"),
    )
