from tidemark.functions.text import event_text, split_lines, split_words
from tidemark.functions.times import (
    END,
    epoch_ms,
    pick,
    row_watermark,
    time_order,
    truncated_window_start,
    window_start,
    with_event_time,
    without_end,
)

__all__ = [
    "END",
    "epoch_ms",
    "event_text",
    "pick",
    "row_watermark",
    "split_lines",
    "split_words",
    "time_order",
    "truncated_window_start",
    "window_start",
    "with_event_time",
    "without_end",
]
