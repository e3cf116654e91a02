"""Benchmark decontamination by the q-gram lemma.

Every window of a benchmark item is searched, from each of its characters on. A text region within ``k`` edits of a
window of ``m`` characters shares at least ``m + 1 - q (k + 1)`` character q-grams with
it, all on ``k + 1`` neighbouring diagonals. Shared q-grams are counted in overlapping
diagonal bands; windows that meet the bound are verified by banded alignment. A window
whose q-grams all follow each other on one diagonal is there without edits, and needs no
alignment. Items too short for that are searched as whole words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import PREFIX, plain_columns

Q = 8
WINDOW = 64
EDIT_RATE = 0.1
# Items with fewer normalised characters only count as exact runs of whole words.
MIN_CHARS = 32
# Characters of benchmark text whose index one pass over the texts carries along.
BLOCK_CHARS = 4_000_000
# Characters of text handled at once; longer texts are read in segments, each of which
# starts with so many normalised characters of the one before.
SEGMENT = 1 << 21
OVERLAP = 4 * WINDOW
# Shared q-grams looked at together; where there are more, the text is halved.
MAX_SHARED = 1 << 20
_MARK = 0x10FFFF  # ends a text; no q-gram reaches over it
_BASE = 0x100000001B3
_FILTER_BITS = 22


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's lower case, a space for all but letters and digits, 0 for the mark."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalnum():
            lowered = char.lower()
            table[code] = ord(lowered) if len(lowered) == 1 else code
    table[_MARK] = 0
    return table


def normalize(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised characters (runs of spaces collapsed) and their places in ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _letters()[codes]
    space = chars == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    if len(keep):
        keep[0] = True
    places = np.flatnonzero(keep)
    return chars[places], places


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every run of ``q`` characters, by doubling the run."""
    if len(chars) < q:
        return np.empty(0, np.uint64)
    part, width = chars.astype(np.uint64), 1
    base = np.uint64(_BASE)
    while width < q:
        step = min(width, q - width)
        factor = np.uint64(pow(_BASE, step, 1 << 64))
        tail = part if step == width else gram_hashes(chars, step)
        n = len(chars) - width - step + 1
        part = part[:n] * factor + tail[width : width + n]
        width += step
    part = part * base
    return part ^ (part >> np.uint64(29))


@dataclass
class Index:
    """q-grams of a block of benchmark items; a window's number is the place it starts at."""

    items: list  # item id by item number
    text: np.ndarray  # the items' characters, one item after the other, and a window of zeros
    item_of: np.ndarray  # item number by place
    start: np.ndarray  # an item's first place, by item number
    length: np.ndarray
    size: np.ndarray  # characters of each of the item's windows
    budget: np.ndarray
    needed: np.ndarray
    grams: np.ndarray  # sorted different q-gram hashes
    first: np.ndarray  # start of each gram's entries, and the end
    place: np.ndarray
    seen: np.ndarray  # filter on the hashes' high bits
    q: int
    short: dict  # sorted hashes and places of the items under the least size, by their size

    @property
    def chars(self) -> np.ndarray:
        """All windows, one row each."""
        return np.lib.stride_tricks.sliding_window_view(self.text, len(self.text) - len(self.item_of) + 1)

    @property
    def of_windows(self) -> np.ndarray:
        return self.length - self.size + 1


def build_index(
    items: list[tuple[object, str]],
    q: int = Q,
    window: int = WINDOW,
    rate: float = EDIT_RATE,
    min_chars: int = MIN_CHARS,
) -> Index | None:
    texts, ids = [], []
    for item_id, text in items:
        chars, _ = normalize((text or "").strip())
        chars = chars[1:] if len(chars) and chars[0] == 32 else chars
        chars = chars[:-1] if len(chars) and chars[-1] == 32 else chars
        if len(chars):
            texts.append(chars)
            ids.append(item_id)
    if not texts:
        return None
    length = np.array([len(t) for t in texts])
    start = np.cumsum(length) - length
    size = np.where(length < min_chars, length, np.minimum(length, window))
    budget = (size * rate).astype(int)
    budget = np.minimum(budget, np.maximum((size - q) // q, 0))  # the lemma needs one gram
    budget[length < min_chars] = 0
    long = [(gram_hashes(t, q), at) for t, at in zip(texts, start.tolist()) if len(t) >= min_chars]
    hashes = np.concatenate([np.empty(0, np.uint64), *(g for g, _ in long)])
    places = np.concatenate([np.empty(0, np.int64), *(np.arange(at, at + len(g)) for g, at in long)])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    distinct, first = np.unique(hashes, return_index=True)
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[distinct >> np.uint64(64 - _FILTER_BITS)] = True
    short = {}
    for n in sorted(set(length[length < min_chars].tolist())):
        at = start[length == n]
        found = np.concatenate([gram_hashes(_spaced(texts[i]), n + 2) for i in np.flatnonzero(length == n)])
        by_hash = np.argsort(found, kind="stable")
        short[n] = found[by_hash], at[by_hash]
    return Index(
        ids, np.concatenate([*texts, np.zeros(max(window, int(size.max())) - 1, np.uint32)]),
        np.repeat(np.arange(len(ids)), length), start, length, size, budget,
        size + 1 - q * (budget + 1), distinct, np.append(first, len(hashes)), places[order], seen, q, short,
    )


def _spaced(chars: np.ndarray) -> np.ndarray:
    """The text between spaces, ends of texts turned into spaces."""
    padded = np.full(len(chars) + 2, 32, np.uint32)
    padded[1:-1] = np.where(chars == 0, 32, chars)
    return padded


def shared_grams(chars: np.ndarray, index: Index, most: int | None = None):
    """Places in the text and in the items of all q-grams that they share.

    None if there are more than ``most``.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = gram_hashes(chars, index.q)
    if not len(index.grams) or not len(hashes):
        return none
    maybe = np.flatnonzero(index.seen[hashes >> np.uint64(64 - _FILTER_BITS)])
    found = np.searchsorted(index.grams, hashes[maybe])
    found[found == len(index.grams)] = 0
    hit = index.grams[found] == hashes[maybe]
    at, gram = maybe[hit], found[hit]
    counts = index.first[gram + 1] - index.first[gram]
    total = int(counts.sum())
    if not total:
        return none
    if most is not None and total > most:
        return None
    entry = np.arange(total) - np.repeat(np.cumsum(counts) - counts - index.first[gram], counts)
    at, place = np.repeat(at, counts), index.place[entry]
    same = np.ones(total, bool)  # characters decide, not hashes
    for i in range(index.q):
        same &= chars[at + i] == index.text[place + i]
    return at[same], place[same]


def exact_windows(at: np.ndarray, place: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a run of q-grams on one diagonal holds whole, and where they begin."""
    if not len(at):
        return place, at
    broad = len(index.item_of)  # by diagonal, then by place
    diagonal, place = np.divmod(np.sort((at - place + broad) * broad + place), broad)
    at = diagonal - broad + place
    item = index.item_of[place]
    follows = (np.diff(place) == 1) & (np.diff(at) == 1) & (np.diff(item) == 0)
    starts = np.flatnonzero(np.append(True, ~follows))
    behind = np.append(starts[1:], len(at))
    run_end = np.repeat(behind, behind - starts)
    needed = (index.size - index.q)[item]
    whole = np.arange(len(at)) + needed < run_end
    return place[whole], at[whole]


def band_candidates(
    at: np.ndarray, place: np.ndarray, index: Index
) -> tuple[np.ndarray, np.ndarray]:
    """Windows and lowest diagonals of the bands with enough shared q-grams.

    A band is ``2 (k + 1)`` diagonals wide and starts at every ``k + 1``-th, so any
    ``k + 1`` neighbouring diagonals lie within one band. In each band of an item the
    shared q-grams are in order of their place, so those of a window follow each other.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(at):
        return none
    item = index.item_of[place]
    place = place - index.start[item]
    # diagonals start at the item's length below the text, to stay positive
    band = (at - place + index.length[item]) // (index.budget[item] + 1)
    bands, longest = int(band.max()) + 2, int(index.length.max())
    keys = (item * bands + band + 1) * longest + place
    keys = np.sort(np.concatenate([keys, keys - longest]))
    shared = keys[np.append(True, keys[1:] != keys[:-1])]
    group, place = np.divmod(keys, longest)
    item, band = group // bands, group % bands - 1
    last = np.arange(len(keys)) + index.needed[item] - 1
    inside = last < len(keys)
    i, last = np.flatnonzero(inside), last[inside]
    reach = (index.size - index.q)[item[i]]
    enough = (group[last] == group[i]) & (place[last] - place[i] <= reach)
    i, last, reach = i[enough], last[enough], reach[enough]
    if not len(i):
        return none
    # every window that holds the q-grams from i to last; both ends rise within a group,
    # so what the one before has named already is left out
    low = np.maximum(place[last] - reach, 0)
    high = np.minimum(place[i], (index.length - index.size)[item[i]])
    again = group[i][1:] == group[i][:-1]
    low[1:] = np.where(again, np.maximum(low[1:], high[:-1] + 1), low[1:])
    wide = np.maximum(high - low + 1, 0)
    offset = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide - low, wide)
    group = np.repeat(group[i], wide)
    few = explained(group * longest + offset, shared, index, group // bands)
    group, offset = group[few], offset[few]
    item, band = group // bands, group % bands - 1
    return index.start[item] + offset, band * (index.budget[item] + 1) - index.length[item] + offset


def explained(
    start: np.ndarray, shared: np.ndarray, index: Index, item: np.ndarray
) -> np.ndarray:
    """Windows whose missing q-grams their budget of edits can explain.

    ``shared`` are the places of a band's q-grams, in order, and ``start`` is a window's
    first. An edit spoils ``q`` q-grams in a row at most, so edits are counted off from
    the first missing one on, as many as are needed at the least.
    """
    runs = np.flatnonzero(np.append(np.diff(shared) != 1, True))
    run_end = np.repeat(shared[runs], np.diff(np.append(-1, runs)))
    end = start + (index.size - index.q)[item]
    place, edits = start.copy(), np.zeros(len(start), np.int64)
    left = np.arange(len(start))
    while len(left):
        at = np.minimum(np.searchsorted(shared, place[left]), len(shared) - 1)
        there = shared[at] == place[left]
        place[left] = np.where(there, run_end[at] + 1, place[left])
        left = left[place[left] <= end[left]]
        edits[left] += 1
        place[left] += index.q
        left = left[edits[left] <= index.budget[item[left]]]
    return edits <= index.budget[item]


def whole_words(chars: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """``window, first, end, 0`` of every short item between spaces or ends of texts."""
    leaks = []
    padded = _spaced(chars) if index.short else chars
    for n, (hashes, places) in index.short.items():
        grams = gram_hashes(padded, n + 2)
        low, high = np.searchsorted(hashes, grams), np.searchsorted(hashes, grams, "right")
        for first in np.flatnonzero(low < high).tolist():
            for place in places[low[first] : high[first]].tolist():
                if np.array_equal(chars[first : first + n], index.text[place : place + n]):
                    leaks.append((place, first, first + n, 0))
    return leaks


def align(
    chars: np.ndarray, windows: np.ndarray, sizes: np.ndarray, low: np.ndarray, width: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each window within its band of diagonals, and where that ends.

    All candidates advance together by one window character; a window may begin at any
    diagonal of its band. Places outside the text match nothing.
    """
    n, broad = len(low), int(width.max())
    column = np.arange(broad)
    outside = column[None, :] >= width[:, None]
    far = np.int32(1 << 20)
    cost = np.where(outside, far, 0).astype(np.int32)
    best = np.full(n, far, np.int32)
    end = np.zeros(n, np.int64)
    for i in range(int(sizes.max())):
        at = low[:, None] + column + i
        valid = (at >= 0) & (at < len(chars))
        same = (chars[np.clip(at, 0, len(chars) - 1)] == windows[:, i : i + 1]) & valid
        step = cost + ~same
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        step[outside] = far
        cost = np.minimum.accumulate(step - column, axis=1) + column
        cost[outside] = far
        done = sizes == i + 1
        if done.any():
            where = cost[done].argmin(axis=1)
            best[done] = cost[done, where]
            end[done] = low[done] + where + i + 1
    return best, end


def find_leaks(chars: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """``window, first, end, edits`` of verified regions of normalised text.

    Every window that is in a text is reported there, in the region with the fewest edits
    and, without edits, in the first. Texts in which q-grams repeat without end are
    halved, with windows to spare, so that what is looked at together is bounded.
    """
    shared = shared_grams(chars, index, MAX_SHARED if len(chars) > 4 * OVERLAP else None)
    if shared is None:
        middle = len(chars) // 2
        tail = [(w, a + middle, b + middle, e) for w, a, b, e in find_leaks(chars[middle:], index)]
        return find_leaks(chars[: middle + OVERLAP], index) + tail
    at, place = shared
    leaks = whole_words(chars, index)
    texts = np.cumsum(chars == 0)
    exact, first = exact_windows(at, place, index)
    size = index.size[index.item_of[exact]]
    keys = texts[np.minimum(first + size // 2, len(chars) - 1)] * len(index.item_of) + exact
    order = np.lexsort((first, keys))
    known, pick = np.unique(keys[order], return_index=True)
    exact, first, size = exact[order][pick], first[order][pick], size[order][pick]
    leaks += zip(exact.tolist(), first.tolist(), (first + size).tolist(), [0] * len(exact))

    window, low = band_candidates(at, place, index)
    item = index.item_of[window]
    middle = np.clip(low + index.budget[item] + 1 + index.size[item] // 2, 0, len(chars) - 1)
    new = ~np.isin(texts[middle] * len(index.item_of) + window, known)
    window, low = window[new], low[new]
    rows, broad = index.chars, index.chars.shape[1]
    for part in range(0, len(window), 1 << 14):
        w, lo = window[part : part + (1 << 14)], low[part : part + (1 << 14)]
        item = index.item_of[w]
        size, budget = index.size[item], index.budget[item]
        edits, end = align(chars, rows[w], size, lo, 2 * (budget + 1))
        end = np.minimum(end, len(chars))  # edits at a text's end may reach over it
        good = edits <= budget
        w, edits, end, size, budget = w[good], edits[good], end[good], size[good], budget[good]
        if not len(w):
            continue
        # the start: the window backwards, from the end found
        turned = np.maximum(size[:, None] - 1 - np.arange(broad), 0)
        backwards = np.take_along_axis(rows[w], turned, axis=1)
        mirrored = len(chars) - end
        _, far_end = align(chars[::-1], backwards, size, mirrored, budget + 1)
        first = np.maximum(len(chars) - far_end, 0)
        leaks += zip(w.tolist(), first.tolist(), end.tolist(), edits.tolist())
    return leaks


def _segments(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, bool, bool]]]]:
    """Normalised characters, their places in their texts, and the pieces they are.

    A piece is a text's number and whether the text has more before and behind it; marks
    stand between pieces. Short texts are joined. A longer text is read in segments that
    begin with the last ``OVERLAP`` normalised characters of the one before, so no
    amount of white space moves a window out of the overlap.
    """
    group: list[tuple[int, str]] = []
    room = SEGMENT

    def joined():
        chars, places = normalize(chr(_MARK).join(text for _, text in group))
        starts = np.cumsum([0, *(len(text) + 1 for _, text in group)])
        places = places - starts[np.searchsorted(starts, places, "right") - 1]
        return chars, places, [(number, False, False) for number, _ in group]

    for number, text in enumerate(texts):
        if not text:
            continue
        if len(text) <= SEGMENT:
            if group and len(text) > room:
                yield joined()
                group, room = [], SEGMENT
            group.append((number, text))
            room -= len(text)
            continue
        chars, places = np.empty(0, np.uint32), np.empty(0, np.int64)
        for first in range(0, len(text), SEGMENT):
            more, where = normalize(text[first : first + SEGMENT])
            if len(chars) and len(more) and chars[-1] == more[0] == 32:
                more, where = more[1:], where[1:]
            before = bool(first) and places[0] > 0
            chars, places = np.concatenate([chars, more]), np.concatenate([places, where + first])
            yield chars, places, [(number, before, first + SEGMENT < len(text))]
            chars, places = chars[-OVERLAP:], places[-OVERLAP:]
    if group:
        yield joined()


def leaks_of_texts(texts: list[str | None], index: Index) -> dict[tuple[int, int], list]:
    """By text and item number: verified windows with place in the text and edits."""
    found: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
    for chars, places, pieces in _segments(texts):
        leaks = find_leaks(chars, index)
        if not leaks:
            continue
        marks = np.flatnonzero(chars == 0)
        for window, first, end, edits in leaks:
            k = int(np.searchsorted(marks, first, "right"))
            number, before, behind = pieces[min(k, len(pieces) - 1)]
            if index.size[index.item_of[window]] == index.length[index.item_of[window]] and (
                before and first == 0 or behind and end == len(chars)
            ):
                # a short item's word may go on in the segment before or after, which has it whole
                if index.budget[index.item_of[window]] == 0:
                    continue
            known = found.setdefault((number, int(index.item_of[window])), {})
            row = (edits, int(places[first]), int(places[end - 1]) + 1)
            known[window] = min(row, known.get(window, row))
    return {key: sorted((w, *row) for w, row in known.items()) for key, known in found.items()}


def benchmark_blocks(
    benchmark: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS
) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``block_chars`` characters, one at a time."""
    items = plain_columns(benchmark, id=id_col, text=text_col).filter(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    blocks = -(-total // block_chars)
    number = F.pmod(F.xxhash64("text", "id"), F.lit(max(blocks, 1)))  # equal items spread too
    for block in range(blocks):
        yield [(r["id"], r["text"]) for r in items.filter(number == block).toLocalIterator()]


def contaminated_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document row and benchmark item found in it.

    A window is any 64 normalised characters of an item, or the whole of a shorter one.
    Returns the ids, ``n_windows`` found of ``of_windows``, ``start`` and ``end`` (code
    points of the whole text that the found windows span) and the fewest ``edits`` of a
    window. A window is found where the normalised text (letters and digits in lower
    case, everything else one space) is within a tenth of its characters in edits.

    Null and empty texts hold nothing; items under 32 normalised characters are searched
    as exact runs of whole words; repeated rows give repeated results; equal items each give a row; null
    ids are kept. Texts are read whole and in place, without a shuffle, once per block
    of ``block_chars`` benchmark characters, which bounds what is broadcast.
    """
    spark = docs.sparkSession
    narrow = plain_columns(docs, doc_id=id_col, text=text_col)
    id_type = benchmark.schema[item_id_col].dataType.simpleString()
    doc_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {doc_type}, item int, n_windows bigint, of_windows bigint, start bigint, "
        "`end` bigint, edits bigint"
    )
    result = None
    for items in benchmark_blocks(benchmark, item_id_col, item_text_col, block_chars):
        index = build_index(items)
        if index is None:
            continue
        part = narrow.mapInArrow(_search(spark, index), schema)
        names = spark.createDataFrame(
            list(enumerate(index.items)), f"item int, item_id {id_type}"
        )
        part = part.join(F.broadcast(names), "item")  # a block's items
        result = part if result is None else result.unionByName(part)
    if result is None:
        empty = f"doc_id {doc_type}, item_id {id_type}, n_windows bigint, of_windows bigint"
        return spark.createDataFrame([], empty + ", start bigint, `end` bigint, edits bigint")
    return result.select("doc_id", "item_id", "n_windows", "of_windows", "start", "end", "edits")


def _search(spark: SparkSession, index: Index):
    shared = spark.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        of_windows = index.of_windows
        for batch in batches:
            leaks = leaks_of_texts(batch.column(1).to_pylist(), index)
            if not leaks:
                continue
            rows = sorted(leaks)
            ids = batch.column(0).take(pa.array([number for number, _ in rows], pa.int64()))
            spans = [leaks[row] for row in rows]
            yield pa.record_batch(
                [
                    ids,
                    pa.array([item for _, item in rows], pa.int32()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([int(of_windows[item]) for _, item in rows], pa.int64()),
                    pa.array([min(x[2] for x in s) for s in spans], pa.int64()),
                    pa.array([max(x[3] for x in s) for s in spans], pa.int64()),
                    pa.array([min(x[1] for x in s) for s in spans], pa.int64()),
                ],
                ["doc_id", "item", "n_windows", "of_windows", "start", "end", "edits"],
            )

    return search


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents without any benchmark item, with the columns they came with."""
    spark = docs.sparkSession
    column = docs.columns.index(text_col)
    for items in benchmark_blocks(benchmark, item_id_col, item_text_col, block_chars):
        index = build_index(items)
        if index is not None:
            docs = docs.mapInArrow(_clean(spark, index, column), docs.schema)
    return docs


def _clean(spark: SparkSession, index: Index, column: int):
    shared = spark.sparkContext.broadcast(index)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks = leaks_of_texts(batch.column(column).to_pylist(), shared.value)
            keep = np.ones(batch.num_rows, bool)
            keep[[number for number, _ in leaks]] = False
            yield batch.filter(pa.array(keep))

    return clean
