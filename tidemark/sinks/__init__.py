from tidemark.sinks.streams import (
    counted_drops,
    latest_values,
    run_available_now,
    run_batches,
    show_stream,
    split_late,
    start_parquet,
    streaming_settings,
)

__all__ = [
    "counted_drops",
    "latest_values",
    "run_available_now",
    "run_batches",
    "show_stream",
    "split_late",
    "start_parquet",
    "streaming_settings",
]
