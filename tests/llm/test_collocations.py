"""Collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase string, k string, n bigint, word string"


def brute(rows, least, percent=100, kept=2000, longest=5):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(upper)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, longest + 1):
                    if i + m <= len(words):
                        f[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            )
            if inside:
                continue
            n = totals[lang]
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:kept], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "état", "new", "york", "x\x00y", "x\x01", "\x01\x02", "b", "zz"]
    docs = []
    for _ in range(n):
        words = []
        while len(words) < rng.randrange(60):
            words += ["in", "spite", "of", "it"] if rng.random() < 0.15 else [rng.choice(vocabulary)]
        seps = rng.choices([" ", "  ", "\t", ", ", "\n", "\x0b", "."], [12, 1, 1, 1, 1, 1, 1], k=len(words))
        docs.append((rng.choice(["en", "fr", None, "und", ""]), "".join(w + s for w, s in zip(words, seps))))
    docs += [("en", None), (None, ""), ("de", " ,. "), ("en", "hot phrase here now " * 500)]
    return docs


@pytest.mark.parametrize("least, percent, kept", [(1, 100, 2000), (8, 100, 30), (20, 60, 2000), (300, 100, 5)])
def test_equals_brute_force(spark, monkeypatch, least, percent, kept):
    rows = texts(least)
    table = spark.createDataFrame([(i, t, g, "c", "c", 1, "c") for i, (g, t) in enumerate(rows)], SCHEMA)
    got = collocations.collocations(table.repartition(7), least=least, percent=percent, kept=kept)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, percent, kept)


def test_full_counters_lose_nothing(spark, monkeypatch):
    """Where all word pairs share a counter no window ends early, and results stay."""
    rows = texts(3)
    table = spark.createDataFrame([(i, t, g, "c", "c", 1, "c") for i, (g, t) in enumerate(rows)], SCHEMA)
    everything = collocations.np.full((1 << collocations.PAIR_BITS) // 8, 255, collocations.np.uint8)
    monkeypatch.setattr(collocations, "frequent_pairs", lambda docs, least: everything)
    assert sorted(map(tuple, collocations.collocations(table, least=10).collect())) == brute(rows, 10)


def test_stripes_cut_anywhere_merge_to_the_same():
    rows = texts(5)
    windows = Counter()
    for lang, text in rows:
        words, joined = collocations.words_of(text)
        for window in collocations.windows_of(words, joined):
            windows[collocations._lang(lang) + b"\x00" + window] += 1
    ordered = sorted(windows.items())

    def merged(size):
        total = Counter()
        for at in range(0, len(ordered), size):
            part = ordered[at : at + size]
            table = collocations.pa.table({"k": collocations.pa.array([k for k, _ in part], "binary"), "n": [n for _, n in part]})
            for lang, m, prefix, following, counts in collocations.stripes_of(table, 5, 10):
                for word, count in zip(following, counts):
                    total[lang, m, prefix, word] += count
        return {k: v for k, v in total.items() if v >= 10}

    whole = merged(len(ordered))
    assert whole and all(merged(size) == whole for size in (1, 7, 100))


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
