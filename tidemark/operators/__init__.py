from tidemark.operators.buffering import chunk_summaries, full_chunks
from tidemark.operators.joins import (
    cogroup_full_join,
    cogroup_left_join,
    interval_join,
    two_stream_join,
    window_join,
)
from tidemark.operators.keyed import average_every_n, periodic_counts
from tidemark.operators.patterns import match_moves, match_patterns, pattern_intervals
from tidemark.operators.reconcile import bill_check, bill_check_repeated
from tidemark.operators.routing import branch, route_alerts, split_by_user
from tidemark.operators.traces import event_timer_trace, watermark_trace
from tidemark.operators.windows import (
    counts_as_text,
    top_per_group,
    truncated_window_counts,
    windowed_counts,
)
from tidemark.operators.wordcount import (
    document_words,
    running_word_count,
    word_count,
    words,
)

__all__ = [
    "average_every_n",
    "bill_check",
    "bill_check_repeated",
    "branch",
    "chunk_summaries",
    "cogroup_full_join",
    "cogroup_left_join",
    "counts_as_text",
    "document_words",
    "event_timer_trace",
    "full_chunks",
    "interval_join",
    "match_moves",
    "match_patterns",
    "pattern_intervals",
    "periodic_counts",
    "route_alerts",
    "running_word_count",
    "split_by_user",
    "top_per_group",
    "truncated_window_counts",
    "two_stream_join",
    "watermark_trace",
    "window_join",
    "windowed_counts",
    "word_count",
    "words",
]
