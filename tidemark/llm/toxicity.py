"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate learning rates and an L1 penalty leave few weights other than zero, which
are small enough to send to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import plain_columns
from tidemark.llm.decontaminate import normalize

HASH_BITS = 20
# Labelled rows a model is fitted on, at most; drawn by a hash of the id.
MAX_TRAIN_ROWS = 16_000
EPOCHS = 8
ALPHA = 1.0
BETA = 1.0
L1 = 6.0
L2 = 0.0
# Characters whose features are computed at once; longer texts go in pieces.
_PIECE = 1 << 20
_BASE = np.uint64(0x100000001B3)
# Odd factors for the left and right word: pairs, and pairs with one or two words between.
_GAPS = {1: (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), 2: (0x165667B19E3779F9, 0x27D4EB2F165667C5), 3: (0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD)}


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (run of letters and digits, in lower case) in order."""
    chars, _ = normalize(text)
    if not len(chars):
        return np.empty(0, np.uint64)
    ends = np.append(np.flatnonzero(chars == 32), len(chars))
    spans = np.diff(ends, prepend=-1)  # a word and the space after it
    place = np.arange(len(chars)) - np.repeat(ends - spans + 1, spans)[: len(chars)]
    values = np.where(chars == 32, np.uint64(0), chars.astype(np.uint64) + np.uint64(1))
    values *= np.cumprod(np.full(int(spans.max()) + 1, _BASE))[place]
    starts = (ends - spans + 1)[spans > 1]
    return _mix(np.add.reduceat(values, starts)) if len(starts) else np.empty(0, np.uint64)


def _pieces(text: str) -> Iterator[str]:
    """A long text cut at white space, near every ``_PIECE`` characters."""
    at = 0
    while len(text) - at > _PIECE:
        cut = at + _PIECE
        while cut < len(text) and not text[cut].isspace():
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def occurrences(text: str | None, bits: int = HASH_BITS) -> np.ndarray:
    """The hashed words of a text, and its pairs of words up to two words apart."""
    if not text:
        return np.empty(0, np.int64)
    words = np.concatenate([word_hashes(piece) for piece in _pieces(text)])
    parts = [words]
    for gap, (left, right) in _GAPS.items():
        parts.append(_mix(words[:-gap] * np.uint64(left) + words[gap:] * np.uint64(right)))
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)


def features(text: str | None, bits: int = HASH_BITS) -> np.ndarray:
    """The different ones among these; a feature counts once however often it occurs."""
    return np.unique(occurrences(text, bits))


@dataclass
class Weights:
    """A sparse model: places and values of the weights other than zero, and the bias."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    bits: int = HASH_BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.value
        return out


class Ftrl:
    """FTRL-proximal state: a gradient sum and a squared-gradient sum per coordinate."""

    def __init__(self, bits: int = HASH_BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z = np.zeros((1 << bits) + 1)  # the last one is the bias
        self.n = np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        gradient = probability(w.sum()) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


def probability(total: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0))))


def fit(
    examples: list[tuple[np.ndarray, float]], epochs: int = EPOCHS, seed: int = 0, **settings
) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the weights other than zero; the bias is the last place."""
    model = Ftrl(**settings)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            model.learn(*examples[i])
    places = np.flatnonzero(model.n)
    values = model.weights(places)
    places, values = places[values != 0], values[values != 0]
    return places, values


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([features(t).astype(np.int32) for t in texts], dtype=object)


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    max_rows: int = MAX_TRAIN_ROWS,
) -> Weights:
    """Fits on about ``max_rows`` labelled rows at most, drawn by a hash of the id.

    Features are computed wherever the rows are; one task learns from them, as each step
    of the method needs the one before. Its input is bounded by ``max_rows``, whatever
    the table's size. Only weights other than zero reach the driver, at most
    ``2 ** HASH_BITS`` of them. Rows without a label are left out; without any labelled
    row the model is empty and scores everything one half.
    """
    rows = plain_columns(labelled, doc_id=id_col, text=text_col, label=label_col)
    rows = rows.filter(F.col("label").isNotNull())
    total = rows.count()
    if total > max_rows:
        limit = int(max_rows / total * (1 << 32))
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < limit)
    drawn = rows.select(
        F.xxhash64("doc_id", "text").alias("place"),
        F.col("label").cast("double").alias("label"),
        _features("text").alias("features"),
    )

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        # in an order of the rows themselves, so that a lost task learns the same again
        group = group.sort_values(["place", "label"], kind="stable")
        examples = [(np.asarray(f, np.int64), y) for f, y in zip(group["features"], group["label"])]
        places, values = fit(examples)
        return pd.DataFrame({"place": places, "value": values})

    model = drawn.groupBy(F.pmod("place", F.lit(1)).alias("all")).applyInPandas(learn, "place bigint, value double").toPandas()
    bias = model["place"] == 1 << HASH_BITS
    return Weights(
        model["place"][~bias].to_numpy(np.int64),
        model["value"][~bias].to_numpy(np.float32),
        float(model["value"][bias].sum()),
    )


def score(text: Column, weights: Weights, df: DataFrame) -> Column:
    """The probability that a text is toxic; null and empty texts score by the bias."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value
        dense = weights.dense()
        for texts in batches:
            scores = []
            for text in texts:
                found = occurrences(text, weights.bits)
                found = np.unique(found[dense[found] != 0])
                scores.append(probability(weights.bias + float(dense[found].sum(dtype=float))))
            yield pd.Series(scores, dtype="float64")

    return compute(text)
