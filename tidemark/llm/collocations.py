"""Phrase collocations by stripes: for each prefix a counter of the words that follow.

Every word position gives one window, the word and up to four behind it in its piece.
Windows are counted in the tasks that read them and dealt by ranges of their order, so
all windows with a common prefix are neighbours and their runs are the prefix's stripe:
each run's size is the counter of a next word. A stripe cut by a range is merged
elementwise. One structure gives extensions, prefix totals and the largest extension.

A window ends early where two words in a row cannot occur often enough together, which a
table of counters shared by many word pairs shows: it never counts too little, so no
phrase is lost, and where it is too small for the text windows just stay longer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns, stored

LONGEST = 5
LEAST = 100
SUBSUMED_PERCENT = 100
KEPT = 2000
NO_LANG = "und"
PIECE_ENDS = re.compile(rb"[.,;:!?\n-\r]+")
# Windows that a task counts before it hands them on, and rows read at once behind that.
HELD_WINDOWS = 200_000
ROWS_AT_ONCE = 1 << 17
# Counters of word pairs, in blocks; only a bit for each is sent to the tasks.
PAIR_BITS = 24
PAIR_BLOCK = 1 << 18
_PAIRS_AT_ONCE = 1 << 20
# Between the words of a window; below every byte of a word once these are escaped.
GAP, ESCAPE = b"\x00", b"\x01"


def _escaped(text: bytes) -> bytes:
    if GAP in text or ESCAPE in text:
        return text.replace(ESCAPE, b"\x01\x02").replace(GAP, b"\x01\x01")
    return text


def _plain(phrase: Column) -> Column:
    spaced = F.replace(phrase, F.lit("\x00"), F.lit(" "))
    return F.replace(F.replace(spaced, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))


def words_of(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and whether each is in one piece with the next."""
    words: list[bytes] = []
    ends = []
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    for piece in PIECE_ENDS.split(_escaped(raw)):
        words += piece.split()
        ends.append(len(words) - 1)
    joined = np.ones(len(words), bool)
    if words:
        joined[[end for end in ends if end >= 0]] = False
    return words, joined


def _lang(lang: str | None) -> bytes:
    return _escaped((NO_LANG if lang is None else lang).encode())


def pair_slots(lang: bytes, words: list[bytes]) -> np.ndarray:
    """The counter of each word with the next; the last word's is meaningless."""
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    mixed = codes * np.uint64(0x9E3779B97F4A7C15) + np.roll(codes, -1) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ np.uint64(zlib.crc32(lang))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def windows_of(words: list[bytes], joined: np.ndarray, longest: int = LONGEST) -> Iterator[bytes]:
    """The windows of all words; a window ends where ``joined`` is false."""
    lengths, going = np.ones(len(words), np.int64), joined
    for step in range(1, longest):
        lengths += going
        going = going & np.append(joined[step:], np.zeros(min(step, len(words)), bool))
    long = np.flatnonzero(lengths > 1)
    ends = (long + lengths[long]).tolist()
    alone = compress(words, (lengths == 1).tolist())
    return chain(alone, map(GAP.join, map(words.__getitem__, map(slice, long.tolist(), ends))))


def _pair_counters(least: int):
    """Each task's pair counters, which stop at ``least``, in blocks."""
    kind = np.min_scalar_type(least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, waiting, n = np.zeros(1 << PAIR_BITS, kind), [], 0

        def add() -> None:
            slots, times = np.unique(np.concatenate(waiting), return_counts=True)
            counters[slots] = np.minimum(counters[slots] + times, least).astype(kind)
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                words, joined = words_of(text.as_py())
                waiting.append(pair_slots(_lang(lang.as_py()), words)[joined])
                n += len(words)
                if n > _PAIRS_AT_ONCE:
                    add()
                    n = 0
        if waiting:
            add()
        for block, at in enumerate(range(0, len(counters), PAIR_BLOCK)):
            part = counters[at : at + PAIR_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "counters"]
                )

    return count


def _frequent_bits(least: int):
    """The blocks of all tasks added up; a bit for each counter that reaches ``least``."""
    kind = np.min_scalar_type(least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counters in zip(batch.column("block").to_pylist(), batch.column("counters")):
                part = np.frombuffer(counters.as_buffer(), kind)
                total = totals.setdefault(block, np.zeros(len(part), np.int64))
                np.minimum(total + part, least, out=total)
        for block, total in totals.items():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

    return add


def frequent_pairs(docs: DataFrame, least: int) -> np.ndarray:
    """One bit per pair counter: 2 MB, whatever the size of the table."""
    counted = docs.mapInArrow(_pair_counters(least), "block int, counters binary")
    rows = counted.repartition("block").mapInArrow(_frequent_bits(least), "block int, bits binary").collect()
    bits = np.zeros((1 << PAIR_BITS) // 8, np.uint8)
    for row in rows:
        at = row["block"] * PAIR_BLOCK // 8
        bits[at : at + PAIR_BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _counted(longest: int, frequent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[bytes, Counter[bytes]] = defaultdict(Counter)

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, windows in held.items():
                keys = pa.array([lang + GAP + w for w in windows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([keys, pa.array(list(windows.values()), pa.int64())], ["k", "n"])
            held.clear()

        bits = frequent.value
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                words, joined = words_of(text.as_py())
                if not words:
                    continue
                name = _lang(lang.as_py())
                slots = pair_slots(name, words)
                joined &= (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)
                held[name].update(windows_of(words, joined, longest))
                if sum(map(len, held.values())) > HELD_WINDOWS:
                    yield from emit()
        yield from emit()

    return count


def _large_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS_AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def stripes_of(table: pa.Table, longest: int, least: int) -> list[tuple]:
    """``lang, m, prefix, next words, counts`` from windows in order.

    The runs that hold the first or the last window may go on elsewhere and are reported
    whatever their size; of the others those of at least ``least``. ``m`` is the length
    of the phrase; the total of a language is that of m = 0.
    """
    words = pc.split_pattern(table["k"].combine_chunks().cast(pa.binary()), GAP)
    counts = table["n"].to_numpy()
    offsets = words.offsets.to_numpy()
    sizes, n_rows = np.diff(offsets), len(counts)
    coded = words.flatten().dictionary_encode()
    codes = np.full((longest + 1, n_rows), -1, np.int64)
    place = np.arange(len(coded)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    codes[place, np.repeat(np.arange(n_rows), sizes)] = coded.indices.to_numpy()
    spelled = coded.dictionary
    changed = np.zeros(n_rows, bool)
    changed[0] = True
    stripes = []
    for m in range(longest + 1):
        changed[1:] |= codes[m][1:] != codes[m][:-1]
        starts = np.flatnonzero(changed)
        totals = np.add.reduceat(counts, starts)
        told = totals >= least
        told[[0, -1]] = True
        told &= codes[m][starts] >= 0
        at, stripe, key = starts[told], None, None
        for row, total in zip(at.tolist(), totals[told].tolist()):
            path = tuple(codes[: max(m, 1), row].tolist())
            if path != key:
                spelling = [spelled[c].as_py() for c in path]
                key, stripe = path, ([], [])
                stripes.append((spelling[0], m, GAP.join(spelling[1:]), *stripe))
            stripe[0].append(spelled[int(codes[m, row])].as_py() if m else b"")
            stripe[1].append(total)
    return stripes


STRIPES = "lang string, m int, prefix string, words array<string>, counts array<bigint>"


def _striped(longest: int, least: int):
    types = [pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]

    def stripe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _large_batches(batches):
            found = stripes_of(table, longest, least)
            columns = [pa.array(column, t).cast(k) for column, t, k in zip(zip(*found), types, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "m", "prefix", "words", "counts"])

    return stripe


def phrase_counts(docs: DataFrame, lang_col: str, text_col: str, longest: int, least: int) -> DataFrame:
    """``lang, m, prefix, word, f``: the merged stripes, with the counts from ``least`` on."""
    narrow = plain_columns(docs, lang=lang_col, text=text_col)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pairs(narrow, least))
    # stored, as the ranges are drawn from a first pass over them
    windows = stored(narrow.mapInArrow(_counted(longest, frequent), "k string, n bigint"), "windows")
    stripes = (
        windows.repartitionByRange("k").sortWithinPartitions("k").mapInArrow(_striped(longest, least), STRIPES)
    )
    entries = stripes.select("lang", "m", "prefix", F.inline(F.arrays_zip("words", "counts")))
    merged = entries.groupBy("lang", "m", "prefix", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    return merged.filter((F.col("f") >= least) | (F.col("m") == 0))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    percent: int = SUBSUMED_PERCENT,
    kept: int = KEPT,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Phrases of 2 to ``longest`` words with ``a >= least`` occurrences are cut where
    ``floor(1000 a n / (l r))`` is smallest, at the first such place; one inside a longer
    phrase that has ``percent`` per cent of its occurrences is dropped; the first ``kept``
    by score, occurrences and spelling stay. It is enough to compare with phrases of one
    word more, since those in between occur as often as the longer. Products are exact
    decimals of 38 digits.

    Null texts are empty, a null language is ``und``; texts are read whole; repeated rows
    count again; a table without phrases gives no row. Other columns are not read. A
    window that many rows share is one row per task before it is shuffled, and a word or
    phrase with many continuations spreads over the ranges of these.
    """
    counts = phrase_counts(docs, lang_col, text_col, longest, least)
    gap = F.lit("\x00")
    spelled = F.when(F.col("m") > 1, F.concat("prefix", gap, "word")).otherwise(F.col("word"))
    counts = stored(counts.select("lang", "m", "prefix", spelled.alias("phrase"), "f"), "phrase-counts")
    totals = counts.filter("m = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("m > 0").select("lang", "phrase", "f")

    behind = lambda column: F.expr(f"substring({column}, instr({column}, char(0)) + 1)")
    longer = counts.filter("m > 2")
    extended = longer.select("lang", F.col("prefix").alias("phrase"), "f").unionByName(
        longer.select("lang", behind("phrase").alias("phrase"), "f")
    )
    extended = extended.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    candidates = counts.filter("m > 1").select("lang", "m", "phrase", F.col("f").alias("a"))
    candidates = candidates.join(extended, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))
    )
    cuts = candidates.select("lang", "phrase", "a", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    words = F.split("phrase", "\x00")
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), "\x00").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.lit(longest)), "\x00").alias("right"),
    )
    cuts = (
        cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(totals, "lang")
    )
    exact = "decimal(19,0)"
    score = F.expr(
        f"(1000BD * cast(a as {exact}) * cast(n as {exact})) div (cast(l as {exact}) * cast(r as {exact}))"
    )
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    plain = scored.select(
        _plain(F.col("lang")).alias("lang"), _plain(F.col("phrase")).alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = plain.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= kept)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
