"""SimHash near-duplicates by covering locality-sensitive hashing.

A set of bit masks is built so that any few differing bits are outside at least one
mask. Fingerprints that differ in no more bits than that therefore share a table entry
for certain; there is no chance of a miss.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import PREFIX, plain_columns, row_hashes, stored
from tidemark.llm.graph import components

BITS = 64
RADIUS = 3
SHINGLE = 3
HASH_SEED = 42
# A table entry with more fingerprints than this is split by finer masks.
MAX_BUCKET = 4096
# Crowded entries up to this number are broadcast; more are joined by shuffle.
MAX_BROADCAST_BUCKETS = 100_000
_CHUNK = 1 << 15
_ODD = 0x9E3779B97F4A7C15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """64-bit hashes of a text's word shingles, in order.

    Words end at ASCII white space and A-Z are lower-cased. A text of fewer words than
    a shingle is one shingle; a text without words, or null, has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        shingles: Iterable[bytes] = [b" ".join(words)]
        total = 1
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        total = len(words) - shingle + 1
        shingles = map(
            joined.__getitem__, map(slice, starts[:total].tolist(), ends[shingle - 1 :].tolist())
        )
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, HASH_SEED) for s in shingles), np.uint64, total)


def fingerprints(text: str | None, shingle: int = SHINGLE, count: int = 1) -> list[int]:
    """``count`` independent 64-bit SimHashes of a text's word shingles.

    A text without words has fingerprint 0.
    """
    hashes = shingle_hashes(text, shingle)
    total = len(hashes)
    if not total:
        return [0] * count
    result = []
    for i in range(count):
        if i:  # an independent hash of each shingle, from the first one
            hashes = hashes + np.uint64(_ODD * i & (1 << 64) - 1)
            hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            hashes = hashes ^ (hashes >> np.uint64(31))
        ones = np.zeros(BITS, np.int64)
        for at in range(0, total, _CHUNK):
            part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        majority = np.packbits(2 * ones > total, bitorder="little").view("<u8")
        result.append(int(majority.astype(np.int64)[0]))
    return result


def fingerprint_column(text: Column, shingle: int = SHINGLE, count: int = 1) -> Column:
    """The fingerprints as an array of signed 64-bit numbers."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprints(t, shingle, count) for t in texts], dtype=object)

    return compute(text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """``2 ** (radius + 1) - 1`` masks; any ``radius`` bits are all outside one of them.

    Every bit carries a non-zero vector of ``radius + 1`` binary digits. A mask belongs
    to a non-zero vector v and holds the bits whose vector has an odd product with v.
    For any ``radius`` vectors some v is orthogonal to all of them. A mask keeps about
    half of the bits.
    """
    vectors = (1 << (radius + 1)) - 1
    carried = [1 + i % vectors for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if (carried[i] & v).bit_count() & 1)
        for v in range(1, vectors + 1)
    ]


def fine_masks(radius: int = RADIUS, bits: int = BITS, blocks: int = 16) -> list[int]:
    """Masks that leave out any ``radius`` of ``blocks`` blocks of bits.

    Any ``radius`` bits lie within ``radius`` blocks, so these cover too. With 16
    blocks of 4 bits an entry has at most 2 ** 12 different fingerprints.
    """
    width = bits // blocks
    full = (1 << bits) - 1
    block = (1 << width) - 1
    return [
        full ^ sum(block << (b * width) for b in left_out)
        for left_out in combinations(range(blocks), radius)
    ]


def spanning_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected by distances up to ``radius`` among ``values``.

    A breadth-first search over the values not seen yet; at most one link per value.
    """
    left = np.unique(values.astype(np.int64)).view(np.uint64)
    sources, targets = [], []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            near = np.bitwise_count(left ^ here) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                sources.append(np.full(len(found), here))
                targets.append(found)
                frontier.extend(found)
    if not sources:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sources).view(np.int64), np.concatenate(targets).view(np.int64)


def _bucket_links(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int32), *[np.empty(0, np.int64)] * 2)]
            series = batch.column(0).to_pylist()
            for j, start, end in zip(series, offsets[:-1].tolist(), offsets[1:].tolist()):
                a, b = spanning_links(values[start:end], radius)
                if len(a):
                    found.append((np.full(len(a), j, np.int32), a, b))
            columns = [pa.array(np.concatenate(column)) for column in zip(*found)]
            yield pa.record_batch(columns, ["j", "a", "b"])

    return link


def _entries(prints: DataFrame, masks: list[int]) -> DataFrame:
    tables = F.array(
        *(F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks))
    )
    return prints.select("j", "fp", F.inline(tables)).select(
        "j", "fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )


def _linked(entries: DataFrame, radius: int) -> DataFrame:
    lists = entries.groupBy("j", "t", "key").agg(F.collect_list("fp").alias("fps"))
    lists = lists.filter(F.size("fps") > 1).select("j", "fps")
    return lists.mapInArrow(_bucket_links(radius), "j int, a bigint, b bigint")


def fingerprint_links(
    prints: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET
) -> DataFrame:
    """Links ``j, a, b`` that connect exactly what distances up to ``radius`` connect.

    ``prints`` has distinct rows ``j, fp``: fingerprints of one or more series j, which
    are linked apart. Entries are counted first. Members of an entry with more than
    ``max_bucket`` fingerprints are compared by way of finer masks instead, whose
    entries cannot be large, so no group is unbounded and no link is lost.
    """
    entries = _entries(prints, covering_masks(radius))
    crowded = (
        entries.groupBy("j", "t", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_bucket)
        .select("j", "t", "key")
    )
    crowded = stored(crowded, "crowded-entries")
    n = len(crowded.take(MAX_BROADCAST_BUCKETS + 1))
    if n == 0:
        return _linked(entries, radius)
    if n <= MAX_BROADCAST_BUCKETS:
        crowded = F.broadcast(crowded)
    on = ["j", "t", "key"]
    usual = entries.join(crowded, on, "left_anti")
    members = entries.join(crowded, on, "left_semi").select("j", "fp").distinct()
    return _linked(usual, radius).unionByName(
        _linked(_entries(members, fine_masks(radius)), radius)
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Equal fingerprints are one node; nodes within ``radius`` bits are linked;
    ``component_id`` is the smallest document id that links reach. Null and empty texts
    have fingerprint 0 and are linked like any other; repeated rows stay rows; null ids
    never are the smallest, and a component of null ids only has a null id. Texts are
    read whole, in one pass; only ids and fingerprints are shuffled.
    """
    narrow = plain_columns(docs, doc_id=id_col, text=text_col)
    prints = narrow.select("doc_id", fingerprint_column(F.col("text"), shingle)[0].alias("fp"))
    prints = stored(prints, "fingerprints")
    return component_of_rows(prints, radius, max_bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_of_rows(prints: DataFrame, radius: int, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Adds ``root``, a name of the component, and ``component_id`` to rows of ``doc_id, fp``."""
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    one_series = classes.select(F.lit(0).alias("j"), "fp")
    roots = components(fingerprint_links(one_series, radius, max_bucket))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id"
    )
    firsts = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = linked.join(firsts, "root").select("fp", "root", "component_id")
    # a fingerprint that many rows share is split by the adaptive skew join
    return prints.join(labels, "fp", "left")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One document of every component of :func:`near_duplicates`, with all its columns.

    The row with the smallest id stays (null ids last, then the smallest row hash), a row
    repeated in every column once. Null and empty texts have fingerprint 0 and are linked
    like any other; an empty table stays empty; columns of any name are kept. Only ids,
    row hashes and fingerprints are grouped; texts are shuffled once, by row hash.
    """
    first_hash, second_hash = row_hashes(docs)
    h1, h2 = f"{PREFIX}h1", f"{PREFIX}h2"
    keyed = docs.withColumn(h1, first_hash).withColumn(h2, second_hash)
    prints = keyed.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(h1).alias("h1"),
        F.col(h2).alias("h2"),
        fingerprint_column(F.col(f"`{text_col}`"), shingle)[0].alias("fp"),
    )
    prints = stored(prints, "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    keepers = component_of_rows(prints, radius).groupBy("root").agg(F.min(rank).alias("first"))
    keepers = keepers.select(F.col("first.h1").alias(h1), F.col("first.h2").alias(h2))
    again = prints.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.take(1):
        keyed = keyed.dropDuplicates([h1, h2])
    kept = keyed.join(keepers, [h1, h2], "left_semi")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
