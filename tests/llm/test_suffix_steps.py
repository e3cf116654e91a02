"""The steps of repeat removal one after another, without Spark, with small limits."""

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tidemark.llm import suffix_dedup as s


def grouped(batches, *keys):
    table = pa.Table.from_batches(batches) if isinstance(batches, list) else batches
    rows = {}
    for number, key in enumerate(zip(*(table[k].to_pylist() for k in keys))):
        rows.setdefault(key, []).append(number)
    return {key: table.take(numbers) for key, numbers in rows.items()}


def remove(docs, buckets):
    """``id: (removed, kept)`` of a list of ``id, bytes``, all in one chunk."""
    press = zstandard.ZstdCompressor()
    ids = pa.array([i for i, _ in docs], pa.int64())
    zeros = pa.array([0] * len(docs), pa.int64())
    plain = pa.record_batch([ids, zeros, pa.array([t.decode() for _, t in docs])], ["key", "chunk", "text"])
    asked = list(s._ask(50, buckets)(iter([plain.slice(0, 20), plain.slice(20)])))
    answers = pa.concat_tables([s._answer(t) for t in grouped(asked, "bucket", "part").values()])
    texts = pa.table(
        [ids, ids, zeros.cast(pa.int32()), zeros, pa.array([press.compress(t) for _, t in docs])],
        ["doc_id", "key", "mark", "chunk", "pressed"],
    )
    dealt = s._emit(50, buckets)(texts, answers)
    spans = pa.concat_tables([s._sort_group(50, s.GRAM)(t) for t in grouped(dealt, "bucket", "part").values()])
    cut = s._cut(texts, spans)
    return dealt, {r["doc_id"]: (r["n_removed"], r["kept"]) for r in cut.to_pylist()}


def brute(docs):
    first, out = {}, {}
    for i, data in sorted(docs):
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first.get(data[at : at + 50], i) < i:
                gone[at : at + 50] = b"\1" * 50
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], i)
        out[i] = (sum(gone), bytes(c for c, g in zip(data, gone) if not g))
    return out


def some_docs(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (60, 49, 50, 51, 130, 400)]
    own = lambda: bytes(rng.choice(b"defgh") for _ in range(rng.randint(0, 150)))
    return [(i, b"".join(rng.choice([*parts, own()]) for _ in range(rng.randint(0, 6)))) for i in range(50)]


@pytest.mark.parametrize("buckets", [1, 5])
@pytest.mark.parametrize("block, slice_size", [(200, 1), (1 << 20, 100), (1500, 1 << 20)])
def test_any_limits_give_the_same_bytes(monkeypatch, buckets, block, slice_size):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    monkeypatch.setattr(s, "SORTED_AT_ONCE", slice_size)
    docs = some_docs(buckets)
    assert remove(docs, buckets)[1] == brute(docs)


def test_equal_hashes_are_not_taken_as_equal_bytes(monkeypatch):
    monkeypatch.setattr(s, "_segment_hashes", lambda hashes, first, size, gram: np.zeros(len(first), np.uint64))
    docs = some_docs(9)
    assert remove(docs, 2)[1] == brute(docs)


def test_texts_of_their_own_are_not_shuffled():
    rng = random.Random(4)
    docs = [(i, bytes(rng.choice(b"abcdefghijklmnop") for _ in range(2000))) for i in range(30)]
    docs[20] = (20, docs[3][1][500:800])
    dealt, cut = remove(docs, 3)
    unpacked = [s._unpack(zstandard.ZstdDecompressor(), v, s._SEGMENT_KINDS) for v in dealt["packed"].to_pylist()]
    assert sum(len(u[6]) for u in unpacked) < 3000
    assert cut == brute(docs) and cut[20][0] == 300


def test_gram_hashes_tell_windows_apart():
    data = np.frombuffer(b"abcabcabdabc" * 5, np.uint8)
    for size in (5, 8, 12, 24):
        hashes = s._gram_hashes(data, size)
        windows = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
        assert len(hashes) == len(windows)
        assert len({*zip(windows, hashes.tolist())}) == len(set(windows)) == len(set(hashes.tolist()))
