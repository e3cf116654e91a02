"""Word counts, final and running."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import split_lines, split_words
from tidemark.plans.ordered import MAX_ROWS, running_counts


def words(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row ``word`` per word; works on tables and streams."""
    return lines.select(F.explode(split_words(F.col(line))).alias("word"))


def word_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """``word, cnt`` over all lines. A stream needs update or complete mode."""
    return words(lines, line).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def document_lines(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, line`` of multi-line documents, numbered from 0."""
    return documents.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))


def document_words(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, pos, word``; ``pos`` is the place in the line, from 0."""
    return document_lines(documents).select(
        "doc_id", "line_no", F.posexplode(split_words(F.col("line"))).alias("pos", "word")
    )


def running_word_count(
    word_rows: DataFrame,
    order: Sequence[str] = ("doc_id", "line_no", "pos"),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``running``: how often the word occurred up to and including the row."""
    return running_counts(word_rows, ["word"], list(order), "running", max_rows)
