"""The trie of conversation prefixes against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, first string"
SMALL = "/root/testdata/sf0.001"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c - 5 * int(c / 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]),
            leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def result(df):
    return sorted(tuple(r) for r in df.collect())


def keyed(rows):
    return sorted(rows, key=repr)


def random_rows(seed, n_convs=60):
    rng = random.Random(seed)
    texts = ["", "ä ö", "yes", "no", "x" * 40]
    rows = []
    for c in rng.sample(range(-40, 200), n_convs):
        for t in range(rng.choice([1, 1, 2, 4, 9, 14])):
            turn = None if rng.random() < 0.05 else t
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice([*texts, None])))
    rows += rng.sample(rows, 10) + [(None, 1, "user", "lost"), (400, 0, "user", "a"), (401, 0, "user", "b")]
    rows += [(c, t, "user", "same") for c in range(1000, 1030) for t in range(3)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    table = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(5)
    assert keyed(map(tuple, prefix_trie.prefix_nodes(table).collect())) == keyed(brute(rows))


def test_long_conversation_in_chunks(spark):
    rows = [(5, t, "user", f"t{t % 7}") for t in range(600)] + [(6, t, "user", f"t{t % 7}") for t in range(600)]
    rows += [(5, None, "user", "again")] * 50 + random_rows(9, 20)
    table = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(5)
    assert keyed(map(tuple, prefix_trie.prefix_nodes(table, max_rows=100).collect())) == keyed(brute(rows))


def test_whole_table(spark):
    table = pq.read_table(f"{SMALL}/conversations.parquet")
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in table.to_pylist()]
    got = prefix_trie.prefix_nodes(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    assert keyed(map(tuple, got.collect())) == keyed(brute(rows))


def test_empty_table(spark):
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0
    lost = spark.createDataFrame([(None, 1, "a", "b", "c", "c")], SCHEMA)
    assert prefix_trie.prefix_nodes(lost).count() == 0


def test_many_shards_merge(spark):
    """With shards of a few paths each, most inner nodes are on a boundary."""
    rows = [(c, t, "u", "same" if t < 12 else str(c % 50)) for c in range(300) for t in range(14)]
    table = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert keyed(map(tuple, prefix_trie.prefix_nodes(table).collect())) == keyed(brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("block", [1, 2, 5, 256])
def test_findclose_equals_a_stack(block):
    rng = np.random.default_rng(block)
    for n in (1, 2, 7, 400):
        bits, open_ = [], 0
        for _ in range(2 * n):  # a random balanced sequence
            if open_ and (sum(bits) == n or rng.random() < 0.5):
                bits.append(0)
                open_ -= 1
            else:
                bits.append(1)
                open_ += 1
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        found = prefix_trie.Parentheses(np.array(bits, bool), block).findclose(np.array(sorted(close)))
        assert found.tolist() == [close[i] for i in sorted(close)]
