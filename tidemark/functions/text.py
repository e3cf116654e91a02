"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_lines(text: Column) -> Column:
    """Lines of a multi-line text, empty lines included."""
    return F.split(text, "\n", -1)


def split_words(line: Column) -> Column:
    """Words between single spaces.

    Leading and inner empty words stay and trailing ones go, so a line of spaces
    only has no word while an empty line has one empty word. Only the space
    character separates.
    """
    trimmed = F.rtrim(line)
    only_spaces = (trimmed == "") & (line != "")
    none = F.array().cast("array<string>")
    return F.when(only_spaces, none).otherwise(F.split(trimmed, " ", -1))


def event_text(name: Column, url: Column, ms: Column) -> Column:
    """One event as readable text."""
    return F.format_string(
        "Event{name='%s', url='%s', timestamp=%d}", name.cast("string"), url, ms
    )
