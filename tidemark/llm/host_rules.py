"""Quality rules with host verdicts.

Every text is measured by rules. Failures of all rules are summed per host, each host's
failure rate is shrunk towards the rate of all hosts by an empirical beta prior, and
the verdict goes back to the documents: the worse the host, the less a text may exceed
the strict rules' limits, and nowhere may it exceed them many times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import PREFIX, plain_columns, stored

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SUSPECT_RATE = 0.5
# A text this many times over a strict limit is rejected in any host.
GROSS = 10.0
# Evidence of an excess grows with this power of it.
EVIDENCE_POWER = 3
# Hosts that reject by strict rules, up to this number are broadcast; more are joined by shuffle.
MAX_BROADCAST_HOSTS = 100_000
# A host's documents are spread over so many keys in the shuffled join.
HOST_SALTS = 64

_MEASURE_SCHEMA = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
_SPACE = {9, 10, 11, 12, 13, 32}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that occurs twice or more.

    Windows are compared exactly: the ranks of two neighbours make the rank of both,
    so three rounds rank windows of eight.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    ranks = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    width = 1
    while width < window:
        step = min(width, window - width)
        pairs = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
        _, ranks = np.unique(pairs, return_inverse=True)
        width += step
    counts = np.bincount(ranks)
    repeated = counts[ranks] > 1
    if not repeated.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += repeated
    edges[window : window + n] -= repeated
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """The five measures of one text; a null text counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # at ASCII white space only
    spaces = sum(text.count(chr(c)) for c in _SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - spaces,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.pandas_udf(_MEASURE_SCHEMA)
def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame(list(map(measure, texts)), columns=list(MEASURES), dtype="int64")


def base_failed():
    """Too short, or a large share inside repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def strict_failed():
    """The rules that bind in suspect hosts only, beside the base rules."""
    return (
        (F.col("n_symbols") * 5 > F.col("n_words"))
        | (F.col("n_dup_lines") * 20 > F.col("n_words"))
        | (F.col("word_chars") > 12 * F.col("n_words"))
    )


def excess():
    """How many times a text is over its most exceeded strict limit; over 1 is a failure."""
    words = F.greatest("n_words", F.lit(1))
    return F.greatest(
        F.col("n_symbols") * 5 / words, F.col("n_dup_lines") * 20 / words, F.col("word_chars") / (12 * words)
    )


def excess_limit(rate: Column, suspect_rate: float = SUSPECT_RATE) -> Column:
    """The excess that a host of this failure rate tolerates: from GROSS down to 1.

    A text is rejected where the host's odds of failure, against those of a suspect
    host, times the excess to the EVIDENCE_POWER are over 1.
    """
    if not 0 < suspect_rate < 1:
        return F.when(rate >= suspect_rate, F.lit(1.0)).otherwise(F.lit(GROSS))
    odds = (1 - rate) / rate * (suspect_rate / (1 - suspect_rate))
    return F.greatest(F.lit(1.0), F.least(F.lit(GROSS), F.pow(odds, F.lit(1.0 / EVIDENCE_POWER))))


def host_rates(measured: DataFrame, host: str = "host", failed: Column | None = None) -> DataFrame:
    """One row per host: documents, failures, largest excess and the shrunk failure rate.

    A document fails if it fails any rule, or as ``failed`` says. The prior is a beta distribution
    fitted to the hosts' rates by moments, each host weighted by its documents: the
    mean is the overall rate, the variance is what differs beyond chance. Hosts that
    differ by no more than chance share one rate. Null hosts count as one host.
    """
    failed = base_failed() | strict_failed() if failed is None else failed
    counts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(failed.cast("bigint")).alias("n_failed"),
        F.max(excess()).alias("max_excess"),
    )
    counts = stored(counts, "host-counts")
    rate = F.col("n_failed") / F.col("n_docs")
    sums = counts.agg(  # one row
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum("n_failed").alias("failed"),
        F.sum(F.col("n_docs") * rate * rate).alias("squares"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("docs_squared"),
    ).first()
    alpha, beta = beta_prior(
        sums["hosts"], sums["docs"] or 0, sums["failed"] or 0, sums["squares"] or 0.0,
        sums["docs_squared"] or 0.0,
    )
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return counts.withColumn("rate", shrunk)


def beta_prior(
    hosts: int, docs: int, failed: int, squares: float, docs_squared: float
) -> tuple[float, float]:
    """Moments of the hosts' failure rates to the two parameters of a beta prior."""
    if hosts == 0 or docs == 0:
        return 1.0, 1.0
    mean = min(max(failed / docs, 1e-6), 1 - 1e-6)
    between = squares - docs * mean * mean
    spread = docs - docs_squared / docs
    variance = (between - (hosts - 1) * mean * (1 - mean)) / spread if spread > 0 else 0.0
    largest = mean * (1 - mean)
    if not variance > 0 or math.isnan(variance):
        strength = 1e6  # no more than chance
    else:
        strength = min(max(largest / min(variance, largest) - 1, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def judge_documents(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    suspect_rate: float = SUSPECT_RATE,
    max_broadcast: int = MAX_BROADCAST_HOSTS,
) -> DataFrame:
    """All columns of ``docs`` with the five measures, ``base_failed`` and ``kept``.

    :func:`judge_measured` says what is kept. Null texts have no words and fail; repeated
    rows are judged alike and all stay rows; an empty table stays empty. Columns of the
    input that are named like a result are replaced. Texts are measured once and written
    with their measures, so hosts are summed up without them.
    """
    results = (*MEASURES, "base_failed", "kept")
    rows = docs.select(
        *(F.col(f"`{c}`") for c in docs.columns if c not in results),
        _measures(F.col(f"`{text_col}`")).alias(f"{PREFIX}m"),
    )
    measured = stored(rows.select("*", f"{PREFIX}m.*").drop(f"{PREFIX}m"), "measured-texts")
    return judge_measured(measured, host_col, suspect_rate, max_broadcast)


def judge_measured(
    measured: DataFrame,
    host_col: str = "host",
    suspect_rate: float = SUSPECT_RATE,
    max_broadcast: int = MAX_BROADCAST_HOSTS,
) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows that carry their measures already.

    ``kept`` is false for documents that fail a base rule, and for those that exceed a
    strict rule's limit more often than their host may (``excess_limit``): once where the
    shrunk failure rate reaches ``suspect_rate``, ``GROSS`` times anywhere. A host's
    verdict never rejects a document that passes every rule; null hosts are judged
    together as one host.
    """
    hosts = measured.select(F.col(f"`{host_col}`").alias("host"), *MEASURES)
    # only hosts with a document over their limit are listed
    limits = (
        host_rates(hosts)
        .select("host", "max_excess", excess_limit(F.col("rate"), suspect_rate).alias("limit"))
        .filter(F.col("max_excess") > F.col("limit"))
        .select("host", "limit")
    )
    return _verdicts(measured, host_col, limits, max_broadcast)


def document_measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``doc_id, host`` and the measures of every text."""
    narrow = plain_columns(docs, doc_id=id_col, host=host_col, text=text_col)
    return narrow.select("doc_id", "host", _measures("text").alias("m")).select(
        "doc_id", "host", "m.*"
    )


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    names = docs.columns
    prefixed = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in names))
    judged = judge_documents(prefixed, f"in_{text_col}", f"in_{host_col}")
    return judged.filter("kept").select(*(F.col(f"`in_{c}`").alias(c) for c in names))


def _verdicts(measured, host_col, limits, max_broadcast) -> DataFrame:
    limit = f"{PREFIX}limit"
    key = F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit("null"))
    listed = limits.select(
        F.coalesce(F.concat(F.lit("h"), F.col("host").cast("string")), F.lit("null")).alias(
            f"{PREFIX}host"
        ),
        F.col("limit").alias(limit),
    )
    rows = measured.withColumn(f"{PREFIX}host", key)
    n = len(listed.take(max_broadcast + 1))
    if n == 0:
        joined = rows.withColumn(limit, F.lit(None).cast("double"))
    elif n <= max_broadcast:
        joined = rows.join(F.broadcast(listed), f"{PREFIX}host", "left")
    else:  # every host's documents go to HOST_SALTS keys
        salt = F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols"), F.lit(HOST_SALTS))
        salted = listed.withColumn(
            f"{PREFIX}salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(HOST_SALTS - 1).cast("bigint")))
        )
        joined = rows.withColumn(f"{PREFIX}salt", salt).join(
            salted, [f"{PREFIX}host", f"{PREFIX}salt"], "left"
        )
    verdict = joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(excess() > F.col(limit), F.lit(False))
    )
    return verdict.drop(f"{PREFIX}host", limit, f"{PREFIX}salt")
