from tidemark.sources.events import click_events, event_table
from tidemark.sources.files import (
    documents,
    socket_lines,
    spread,
    table_stream,
    text_lines,
    text_stream,
)
from tidemark.sources.orders import app_orders, third_orders
from tidemark.sources.replay import END_MS, range_cuts, replay

__all__ = [
    "END_MS",
    "app_orders",
    "click_events",
    "documents",
    "event_table",
    "range_cuts",
    "replay",
    "socket_lines",
    "spread",
    "table_stream",
    "text_lines",
    "text_stream",
    "third_orders",
]
