"""Removal of repeated byte strings by deep-shallow suffix sorting.

Every string of ``length`` bytes is a suffix cut short. The suffixes are dealt out by
their minimizer: the smallest hash among the short grams inside. Equal strings have equal
minimizers, and neighbouring suffixes mostly share one, so a run of them travels as one
segment of text. First only the minimizers travel, and each document learns which of its
own some other document has; segments of the others cannot hold a repeat and stay. Where
segments with equal minimizers meet, their suffixes are sorted: multikey quicksort, eight bytes at a time, down to a shallow depth, and blind tries for
the groups that are still together there. Suffixes that are equal in full then stand side
by side, and all but those of the smallest document id are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns

LENGTH = 50
GRAM = 16
# Bytes of text from which one batch of segments is made.
BLOCK_BYTES = 3 << 20
# Bytes of segments that one group holds, about.
GROUP_BYTES = 32 << 20
# Bytes of text that one chunk of documents holds, about.
CHUNK_BYTES = 16 << 20
# Suffixes that are sorted at a time; more only if they share one minimizer.
SORTED_AT_ONCE = 1 << 20
# Words of eight bytes that multikey quicksort compares before blind tries take over.
SHALLOW_WORDS = 3
_PLACE_BITS = 24
_LAST_ID = np.iinfo(np.int64).max  # a null id comes after all others
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _random_bytes_table() -> np.ndarray:
    """A fixed 64-bit number for each byte value."""
    return np.array(
        [int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest(), "little") for i in range(256)],
        np.uint64,
    )


_TABLE = _random_bytes_table()


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` bytes, by joining two runs of half the length or more."""
    part, width = _TABLE[data], 1
    while width < size:
        step = min(width, size - width)
        part = part[:-step] * np.uint64(pow(int(_BASE), step, 1 << 64)) + part[step:]
        width += step
    return _mix(part)


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``first, count, minimizer`` of the runs of suffixes that share a minimizer, and
    the hashes of all grams.

    ``ends`` are the ends of the documents within ``data``; suffixes stay inside one.
    """
    empty = np.empty(0, np.int64)
    n = len(data) - length + 1
    if n < 1:
        return empty, empty, empty, np.empty(0, np.uint64)
    hashes = _gram_hashes(data, gram)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    ranked = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    window, width = length - gram + 1, 1
    while width * 2 <= window:
        ranked = np.minimum(ranked[:-width], ranked[width:])
        width *= 2
    if width < window:
        ranked = np.minimum(ranked[: len(ranked) - (window - width)], ranked[window - width :])
    minimizer = (ranked[:n] & mask).astype(np.int64)
    inside = np.ones(n, bool)
    for end in ends[:-1].tolist():  # suffixes that begin in one document and end in the next
        inside[max(end - length + 1, 0) : end] = False
    change = np.ones(n, bool)
    change[1:] = (minimizer[1:] != minimizer[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    count = np.diff(first, append=n)
    kept = inside[first]
    first, count = first[kept], count[kept]
    return first, count, minimizer[first], hashes


def _segment_hashes(hashes: np.ndarray, first: np.ndarray, size: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each segment, from those of grams that cover it."""
    total = size.astype(np.uint64)
    for offset in range(0, int(size.max(initial=0)), gram):
        total = _mix(total * _BASE + hashes[first + np.minimum(offset, size - gram)])
    return total


def _gather(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = int(size.sum())
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    return data[np.arange(total) + shift]


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each minimizer and 32 bits of its hash in one number."""
    return (hashes % np.uint64(buckets)) << np.uint64(32) | hashes >> np.uint64(32)


def _equal_to(data: np.ndarray, first: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``first`` on are those from ``other`` on."""
    equal = np.ones(len(first), bool)
    for at in range(0, len(first), 1 << 14):
        part = slice(at, at + (1 << 14))
        differ = _gather(data, first[part], size[part]) != _gather(data, other[part], size[part])
        equal[part] = ~np.logical_or.reduceat(differ, np.cumsum(size[part]) - size[part])
    return equal


def runs(places: np.ndarray, length: int, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the ``places``, in order by piece, that one maximal stretch of
    strings of ``length`` covers."""
    fresh = np.diff(places, prepend=places[:1]) > length
    fresh |= np.diff(piece, prepend=-1) != 0
    begin = np.flatnonzero(fresh)
    return begin, np.append(begin[1:], len(places))[: len(begin)] - 1


# --- sorting ------------------------------------------------------------------------


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    words, width = data.astype(np.uint64), 1
    while width < 8:
        words <<= np.uint64(8 * width)
        words[:-width] |= words[width:] >> np.uint64(8 * width)
        width *= 2
    return words


def _words(eights: np.ndarray, at: np.ndarray, offset: int, used: int) -> np.ndarray:
    """Eight bytes from each place on as one number; bytes past ``used`` count as zero."""
    word = eights[np.minimum(at + offset, len(eights) - 1)]
    rest = np.uint64(8 * (8 - used))
    return word >> rest << rest


def _numbered(group: np.ndarray) -> np.ndarray:
    """Groups that stand side by side, numbered from 0."""
    return np.cumsum(np.diff(group, prepend=group[:1]) != 0)


def _unequal(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which of the groups, numbered from 0, differ in a value."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    found = np.zeros(len(starts), bool)
    found[group[value != value[starts][group]]] = True
    return found


def _regroup(group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and word, and new group numbers along it; groups that agree in the
    word stay as they are."""
    order = np.arange(len(group))
    part = np.flatnonzero(_unequal(group, word)[group])
    order[part] = part[np.lexsort((word[part], group[part]))]
    w = word[order]
    fresh = np.ones(len(group), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (w[1:] != w[:-1])
    return order, np.cumsum(fresh) - 1


def _shared(group: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Members of groups that more than one document has."""
    return _unequal(group, owner)[group]


def _unlike(eights: np.ndarray, at: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Suffixes without those that are unlike every suffix of other owners, by their hash."""
    spread = np.zeros(max(len(eights) - length + 1, 0), np.uint64)
    for offset in [*range(0, length - 7, 8), length - 8] if length >= 8 else []:
        spread = (spread ^ eights[offset : offset + len(spread)]) * _BASE
        spread ^= spread >> np.uint64(29)
    bits = max(len(at).bit_length() + 1, 4)
    slot = (_mix(spread)[at] >> np.uint64(64 - bits)).astype(np.int64)
    last = np.empty(1 << bits, owner.dtype)
    last[slot] = owner  # one of a slot's owners
    met = np.zeros(1 << bits, bool)
    met[slot[last[slot] != owner]] = True
    return np.flatnonzero(met[slot])


def equal_suffixes(
    data: np.ndarray, at: np.ndarray, owner: np.ndarray, length: int = LENGTH,
    shallow_words: int = SHALLOW_WORDS,
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (numbers into ``at``) that several owners share, and their groups.

    Groups are equal in all ``length`` bytes. A group that only one owner is left in is
    dropped wherever it appears, as none of its members can be a repeat.
    """
    eights = _eights(data)
    members = _unlike(eights, at, owner, length)
    group = np.zeros(len(members), np.int64)
    words = -(-length // 8)
    # multikey quicksort to a shallow depth
    for k in range(min(shallow_words, words)):
        if not len(members):
            return members, group
        word = _words(eights, at[members], 8 * k, min(8, length - 8 * k))
        if k == 0:
            order = np.argsort(word)
            sorted_words = word[order]
            group = _numbered(sorted_words)
            members = members[order]
        else:
            order, group = _regroup(group, word)
            members = members[order]
        kept = _shared(group, owner[members])
        members, group = members[kept], _numbered(group[kept])
    if not len(members) or shallow_words >= words:
        return members, group
    # blind tries: skip what a group has in common, branch on the first word that differs
    rest = np.stack(
        [_words(eights, at[members], 8 * k, min(8, length - 8 * k)) for k in range(shallow_words, words)]
    )
    done, names, named = [members[:0]], [group[:0]], 0
    while len(members):
        differs = np.stack([_unequal(group, row) for row in rest])
        open_groups = differs.any(axis=0)
        left = open_groups[group]
        done.append(members[~left])
        names.append(group[~left] + named)
        named += len(open_groups)
        branch = differs.argmax(axis=0)[group[left]]
        members, rest, group = members[left], rest[:, left], _numbered(group[left])
        order, group = _regroup(group, rest[branch, np.arange(len(members))])
        kept = _shared(group, owner[members[order]])
        order, group = order[kept], _numbered(group[kept])
        members, rest = members[order], rest[:, order]
    return np.concatenate(done), _numbered(np.concatenate(names))


# --- Spark --------------------------------------------------------------------------

_SEGMENT_ROWS = "bucket bigint, part bigint, packed binary"
_SPANS = "key bigint, mark int, start bigint, `end` bigint"
_ANSWERS = "chunk bigint, codes binary"
_CUT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
    "spans array<struct<start:bigint,`end`:bigint>>, kept binary"
)
_SEGMENT_KINDS = (np.int64, np.int32, np.int32, np.int64, np.uint8, np.uint8, np.uint8)
_ASKED_KINDS = (np.int64, np.int64, np.int32, np.uint64, np.uint8)
_LEVEL = 5


def _pack(press: zstandard.ZstdCompressor, arrays: list[np.ndarray], kinds: tuple) -> bytes:
    """Arrays of ``kinds`` in one frame, their lengths first."""
    parts = [np.ascontiguousarray(a.astype(k, copy=False)) for a, k in zip(arrays, kinds)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return press.compress(b"".join([sizes.tobytes(), *(p.tobytes() for p in parts)]))


def _unpack(press: zstandard.ZstdDecompressor, value: bytes, kinds: tuple) -> list[np.ndarray]:
    data = press.decompress(value)
    sizes = np.frombuffer(data, np.int64, len(kinds))
    arrays, at = [], sizes.nbytes
    for kind, size in zip(kinds, sizes.tolist()):
        arrays.append(np.frombuffer(data, kind, size, at))
        at += arrays[-1].nbytes
    return arrays


def _filled(
    documents: Iterator[tuple[int, int, bytes]], length: int
) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of ``id, mark, first byte, bytes``; a long text comes in overlapping pieces."""
    block: list[tuple[int, int, int, bytes]] = []
    held = 0
    for doc_id, mark, data in documents:
        if len(data) < length:
            continue
        doc_id = _LAST_ID if doc_id is None else doc_id
        for first in range(0, len(data) - length + 1, BLOCK_BYTES):
            piece = data[first : first + BLOCK_BYTES + length - 1]
            if block and held + len(piece) > BLOCK_BYTES + length:
                yield block
                block, held = [], 0
            block.append((doc_id, mark, first, piece))
            held += len(piece)
    if block:
        yield block


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Blocks of the texts of ``id, mark, text``."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    texts = ((i, mark, (text or "").encode("utf-8", "surrogatepass")) for i, mark, text in rows)
    return _filled(texts, length)


def _pressed_blocks(table: pa.Table, length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Blocks of the compressed texts of a chunk."""
    press = zstandard.ZstdDecompressor()
    columns = (table[name].to_pylist() for name in ("key", "mark", "pressed"))
    return _filled(((key, mark, press.decompress(text)) for key, mark, text in zip(*columns)), length)


class _Block:
    """The segments of a list of pieces, those of the smallest id first."""

    def __init__(self, pieces: list[tuple], length: int):
        pieces.sort(key=lambda piece: piece[:3])
        sizes = np.array([len(piece[3]) for piece in pieces])
        ends = np.cumsum(sizes)
        self.data = np.frombuffer(b"".join(piece[3] for piece in pieces), np.uint8)
        self.first, self.count, self.minimizer, self.hashes = segments(self.data, ends, length)
        self.piece = np.searchsorted(ends, self.first, "right")
        self.ids = np.array([p[0] for p in pieces], np.int64)
        self.marks = np.array([p[1] for p in pieces], np.int64)
        self.shifts = np.array([p[2] for p in pieces], np.int64) - (ends - sizes)


_PACKED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("packed", pa.binary())])


def _packed_batches(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, 64)):
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*some), _PACKED.types)], _PACKED)


def _bucket_parts(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and the places where it stands, in order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-2))
    for part in np.split(order, cuts[1:]):
        if len(part):
            yield int(bucket[part[0]]), part


def _ask(length: int, buckets: int):
    """The minimizers of each document by bucket, with the document's chunk as its mark.
    One that several documents of a block have is known to be met: it is asked once for
    all blocks, and told in bucket -1."""

    def rows(batches):
        press = zstandard.ZstdCompressor(level=_LEVEL)
        for pieces in _blocks(batches, length):
            block = _Block(pieces, length)
            code, piece = _codes(block.hashes[block.minimizer], buckets), block.piece
            order = np.argsort(code, kind="stable")  # pieces are in order of id
            code, piece = code[order], piece[order]
            fresh = np.diff(code, prepend=~code[:1]) != 0
            single = fresh | (np.diff(piece, prepend=-1) != 0)
            code, piece, fresh = code[single], piece[single], fresh[single]
            starts = np.flatnonzero(fresh)
            lasts = np.append(starts[1:], len(code)) - 1
            many = block.ids[piece[starts]] != block.ids[piece[lasts]] if len(code) else fresh
            known = many[np.cumsum(fresh) - 1] if len(code) else fresh
            asked = np.flatnonzero(fresh | ~known)
            told = np.flatnonzero(known)
            bucket = (code >> np.uint64(32)).astype(np.int64)
            parts = [(number, asked[part]) for number, part in _bucket_parts(bucket[asked])]
            if len(told):
                parts.append((-1, told))
            for number, part in parts:
                part = part[np.argsort(piece[part], kind="stable")]
                held, counts = np.unique(piece[part], return_counts=True)
                arrays = [block.ids[held], block.marks[held], counts, code[part], known[part]]
                part_number = 0 if number >= 0 else int(block.ids[0] % buckets)
                yield number, part_number, _pack(press, arrays, _ASKED_KINDS)

    return lambda batches: _packed_batches(rows(batches))


def _answer(table: pa.Table) -> pa.Table:
    """The minimizers of each chunk's documents that another document has as well."""
    press = zstandard.ZstdDecompressor()
    unpacked = [_unpack(press, value.as_py(), _ASKED_KINDS) for value in table["packed"]]
    ids, chunks, counts, code, known = (np.concatenate([u[k] for u in unpacked]) for k in range(5))
    piece = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    if table["bucket"][0].as_py() >= 0:
        order = np.argsort(code)
        fresh = np.diff(code[order], prepend=~code[order][:1]) != 0
        starts, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        owner = ids[piece[order]]
        met = np.maximum.reduceat(known[order], starts) > 0
        met |= np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        found = order[met[group] & (known[order] == 0)]
        found.sort()
        piece, code = piece[found], code[found]
    order = np.lexsort((code, chunks[piece]))
    chunk, code = chunks[piece][order], code[order]
    once = (np.diff(chunk, prepend=-1) != 0) | (np.diff(code, prepend=~code[:1]) != 0)
    chunk, code = chunk[once], code[once]
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    offsets = np.append(starts * 8, len(code) * 8).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(code.tobytes())]
    codes = pa.Array.from_buffers(pa.binary(), len(starts), buffers)
    return pa.table([pa.array(chunk[starts], pa.int64()), codes], ["chunk", "codes"])


def _emit(length: int, buckets: int):
    """A chunk's segments whose minimizer is met elsewhere, by bucket. Of segments equal
    within a block only the smallest id's go on; the rest are repeats, which is noted in
    bucket -1."""

    def rows(texts, answers):
        press = zstandard.ZstdCompressor(level=_LEVEL)
        codes = np.unique(np.frombuffer(b"".join(answers["codes"].to_pylist()), np.uint64))
        for pieces in _pressed_blocks(texts, length):
            block = _Block(pieces, length)
            code = _codes(block.hashes[block.minimizer], buckets)
            met = np.flatnonzero(np.isin(code, codes))
            first, minimizer, piece = block.first[met], block.minimizer[met], block.piece[met]
            size = block.count[met] + length - 1
            bucket = (code[met] >> np.uint64(32)).astype(np.int64)
            shape = _segment_hashes(block.hashes, first, size, GRAM)
            block.hashes = None
            order = np.argsort(shape, kind="stable")  # pieces are in order of id
            fresh = np.diff(shape[order], prepend=~shape[order][:1]) != 0
            ahead = order[fresh][np.cumsum(fresh) - 1]  # the first of equal hash
            later = block.ids[piece[order]] > block.ids[piece[ahead]]
            later &= size[order] == size[ahead]
            order, ahead = order[later], ahead[later]
            equal = _equal_to(block.data, first[order], size[order], first[ahead])
            bucket[order[equal]] = -1
            for number, part in _bucket_parts(bucket):
                held, counts = np.unique(piece[part], return_counts=True)
                starts = first[part] + block.shifts[piece[part]]
                arrays = [block.ids[held], block.marks[held], counts, np.diff(starts, prepend=0), size[part]]
                if number >= 0:
                    arrays += [(minimizer - first)[part], _gather(block.data, first[part], size[part])]
                else:  # repeats already: spread over parts of their own
                    arrays += [np.empty(0, np.uint8)] * 2
                part_number = 0 if number >= 0 else int(block.ids[0] % buckets)
                yield number, part_number, _pack(press, arrays, _SEGMENT_KINDS)

    def emit(texts: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_packed_batches(rows(texts, answers)), _PACKED)

    return emit


def _spans_table(ids, marks, piece, places, length) -> pa.Table:
    """The stretches that flagged suffixes cover, one row each."""
    order = np.lexsort((places, piece))
    piece, places = piece[order], places[order]
    begin, end = runs(places, length, piece)
    held = piece[begin]
    columns = [pa.array(ids[held], pa.int64()), pa.array(marks[held], pa.int32())]
    columns += [pa.array(places[begin], pa.int64()), pa.array(places[end] + length, pa.int64())]
    return pa.table(columns, ["key", "mark", "start", "end"])


def _sort_group(length: int, gram: int):
    def sort(table: pa.Table) -> pa.Table:
        press = zstandard.ZstdDecompressor()
        unpacked = [_unpack(press, value.as_py(), _SEGMENT_KINDS) for value in table["packed"]]
        ids, marks, counts = (np.concatenate([u[k] for u in unpacked]) for k in range(3))
        starts = np.concatenate([np.cumsum(u[3]) for u in unpacked])
        size, offset = (np.concatenate([u[k] for u in unpacked]).astype(np.int64) for k in (4, 5))
        data = np.concatenate([u[6] for u in unpacked])
        del unpacked
        piece = np.repeat(np.arange(len(ids)), counts)
        if table["bucket"][0].as_py() < 0:  # repeats already
            count = size - length + 1
            places = np.repeat(starts - np.concatenate(([0], np.cumsum(count)[:-1])), count)
            places += np.arange(int(count.sum()))
            return _spans_table(ids, marks, np.repeat(piece, count), places, length)
        begin = np.cumsum(size) - size
        # segments whose minimizer no other document has cannot hold a repeat
        at = begin + offset
        gram_hash = np.zeros(len(at), np.uint64)
        for k in range(0, gram, 8):
            word = data[(at + k)[:, None] + np.arange(8)].view(">u8").ravel()
            gram_hash = _mix(gram_hash * _BASE + word.astype(np.uint64))
        order, group = _regroup(np.zeros(len(at), np.int64), gram_hash)
        shared = _shared(group, ids[piece[order]])
        met, group = order[shared], group[shared]
        count = size[met] - length + 1
        # whole groups at a time, as many as make up a slice
        ahead = (np.cumsum(count) - count)[np.flatnonzero(np.diff(group, prepend=-1))]
        number = (ahead // SORTED_AT_ONCE)[_numbered(group)]
        pieces, places = [piece[:0]], [starts[:0]]
        for part in np.split(np.arange(len(met)), np.flatnonzero(np.diff(number)) + 1):
            segment, n = met[part], count[part]
            ends = np.cumsum(n)
            inner = np.arange(int(n.sum())) - np.repeat(ends - n, n)
            held = np.repeat(np.arange(len(part)), n)
            local = _gather(data, begin[segment], size[segment])
            suffix = (np.cumsum(size[segment]) - size[segment])[held] + inner
            owner = ids[piece[segment]][held]
            members, same = equal_suffixes(local, suffix, owner, length)
            if not len(members):
                continue
            first = np.flatnonzero(np.diff(same, prepend=-1))
            smallest = np.minimum.reduceat(owner[members], first)[same]
            members = members[owner[members] > smallest]
            pieces.append(piece[segment][held[members]])
            places.append(starts[segment][held[members]] + inner[members])
        return _spans_table(ids, marks, np.concatenate(pieces), np.concatenate(places), length)

    return sort


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compressed text in place of ``text``, for the way to its chunk."""
    press = zstandard.ZstdCompressor(level=_LEVEL)
    names = ["doc_id", "key", "mark", "chunk"]
    for batch in batches:
        texts = [
            press.compress((t or "").encode("utf-8", "surrogatepass"))
            for t in batch.column("text").to_pylist()
        ]
        columns = [batch.column(name) for name in names]
        yield pa.record_batch([*columns, pa.array(texts, pa.binary())], [*names, "pressed"])


def _cut(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """The texts of a chunk without the stretches found in it."""
    press = zstandard.ZstdDecompressor()
    key, mark, start, end = (spans[n].to_numpy() for n in ("key", "mark", "start", "end"))
    order = np.lexsort((start, mark, key))
    key, mark, start, end = key[order], mark[order], start[order], end[order]
    firsts = np.flatnonzero((np.diff(key, prepend=key[:1] - 1) != 0) | (np.diff(mark, prepend=-1) != 0))
    lasts = np.append(firsts[1:], len(key))
    places = dict(zip(zip(key[firsts].tolist(), mark[firsts].tolist()), zip(firsts.tolist(), lasts.tolist())))
    sizes, removed, pieces, kept, stretches = [], [], [], [], []
    for doc, of, text in zip(*(texts[n].to_pylist() for n in ("key", "mark", "pressed"))):
        data = press.decompress(text)
        a, b = places.get((doc, of), (0, 0))
        merged: list[list[int]] = []
        for first, last in zip(start[a:b].tolist(), end[a:b].tolist()):
            if merged and first <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        edges = [0, *(edge for pair in merged for edge in pair), len(data)]
        left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        sizes.append(len(data))
        removed.append(len(data) - len(left))
        pieces.append(len(merged))
        stretches.append([{"start": a, "end": b} for a, b in merged])
        kept.append(left)
    numbers = [pa.array(values, pa.int64()) for values in (sizes, removed, pieces)]
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        [texts["doc_id"], *numbers, pa.array(stretches, stretch), pa.array(kept, pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` per row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a
    smaller id. ``spans`` are the maximal stretches removed, ``kept`` the bytes left.
    Strings never reach from one document into another. Ids are whole numbers; a null id
    is larger than all others. Rows of equal id are one age: they remove nothing from
    each other. Null and short texts keep all they have; an empty table stays empty.

    Texts are read whole. Only segments with a minimizer that another document has are
    shuffled. Equal ones are reduced to the smallest id in every block of text before, so
    a string that a third of the documents hold reaches its group once per block. Groups
    are as many as the table's size asks for, and so are the chunks that documents are
    dealt to by id and text, where they get their answers and lose their repeats.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    rows = plain_columns(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(_LAST_ID))).alias("key"),
        mark.alias("mark"),
        "text",
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    per_byte = 1 + 2 * (length - 1) / (length - GRAM + 2)  # of segments, for a byte of text
    buckets = max(1, int(total * per_byte / group_bytes))
    chunk = F.pmod(F.xxhash64("key", "mark"), F.lit(total // CHUNK_BYTES + 1)).alias("chunk")
    # both uses of the chunks read one shuffle of the texts
    chunks = (
        rows.select("doc_id", "key", "mark", chunk, "text")
        .mapInArrow(_pressed, "doc_id bigint, key bigint, mark int, chunk bigint, pressed binary")
        .groupBy("chunk")
    )
    asked = rows.select("key", chunk, "text").mapInArrow(_ask(length, buckets), _SEGMENT_ROWS)
    answers = asked.groupBy("bucket", "part").applyInArrow(_answer, _ANSWERS)
    dealt = chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_emit(length, buckets), _SEGMENT_ROWS)
    spans = dealt.groupBy("bucket", "part").applyInArrow(_sort_group(length, GRAM), _SPANS)
    return chunks.cogroup(spans.select("*", chunk).groupBy("chunk")).applyInArrow(_cut, _CUT)
