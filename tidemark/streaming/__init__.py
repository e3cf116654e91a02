from tidemark.streaming.buffering import dealt_chunks
from tidemark.streaming.joins import (
    cogroup_full_join,
    cogroup_left_join,
    interval_join,
    two_stream_join,
    window_join,
)
from tidemark.streaming.keyed import (
    average_every_n,
    bill_check,
    bill_check_repeated,
    event_timer_trace,
    controlled_matches,
    full_chunks,
    pattern_matches,
    periodic_counts,
    previous_actions,
)
from tidemark.streaming.running import running_totals
from tidemark.streaming.windows import top_windows, windowed_counts

__all__ = [
    "average_every_n",
    "bill_check",
    "bill_check_repeated",
    "cogroup_full_join",
    "cogroup_left_join",
    "controlled_matches",
    "dealt_chunks",
    "event_timer_trace",
    "full_chunks",
    "interval_join",
    "pattern_matches",
    "periodic_counts",
    "previous_actions",
    "running_totals",
    "top_windows",
    "two_stream_join",
    "window_join",
    "windowed_counts",
]
