"""Declared record schemas; nothing is inferred from data."""

from pyspark.sql import types as T

EVENTS_TABLE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

DOCUMENTS_TABLE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

CLICK_ROWS = "event_id bigint, user_id bigint, url string, value double, ms bigint"
CLICKS = "name string, url string, timestamp bigint"
URL_VIEW_COUNTS = "url string, count bigint, windowStart bigint, windowEnd bigint"
APP_ORDERS = "order_id string, platform string, ts_ms bigint"
THIRD_ORDERS = "order_id string, platform string, status string, ts_ms bigint"
ACTIONS = "user_id string, action string, ms bigint, id bigint"
PATTERNS = "action1 string, action2 string, ms bigint"
