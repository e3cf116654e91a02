"""The trie of conversation prefixes, as balanced parentheses per shard.

A node is a distinct sequence of first turns. Chains without branch or end are folded
away; the nodes left are written as balanced parentheses by shards of neighbouring
conversations. In a shard a range min-max structure finds where a subtree closes,
ranks count its leaves, and cumulative weights give its savings. Nodes on a shard's first
and last path may go on in other shards; their sums are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns, stored
from tidemark.plans.ordered import MAX_ROWS, running_totals

# A rebuilt conversation starts with turns of the first of its block of so many ids.
FAMILY = 5
# ... up to this many, less one.
HEADS = 9
# Parentheses in a block of the excess structure.
PAREN_BLOCK = 256
# Characters of ids joined before they are hashed in turn.
JOINED_CHARS = 1 << 16
# The name of the prefix without turns.
ROOT = "0-0-0"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A balanced sequence of parentheses with the excess range per block."""

    def __init__(self, bits: np.ndarray, block: int = PAREN_BLOCK):
        self.bits, self.block = bits, block
        self.excess = np.cumsum(np.where(bits, 1, -1))
        starts = np.arange(0, len(bits), block)
        self.lows = [np.minimum.reduceat(self.excess, starts)] if len(bits) else [np.empty(0, int)]
        while len(self.lows[-1]) > 1:  # every level holds the minima of pairs
            row = self.lows[-1]
            row = np.append(row, np.iinfo(row.dtype).max) if len(row) % 2 else row
            self.lows.append(np.minimum(row[::2], row[1::2]))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one.

        It is the first later place whose excess is one less: sought in the block itself,
        then up and down the tree of block minima, then in the block found.
        """
        target = self.excess[opens] - 1
        found = np.full(len(opens), -1, np.int64)
        ends = np.minimum((opens // self.block + 1) * self.block, len(self.bits))
        self._scan(opens + 1, ends, target, found, np.arange(len(opens)))
        left = np.flatnonzero(found < 0)
        node, level = opens[left] // self.block, np.zeros(len(left), np.int64)
        climbing = np.arange(len(left))
        while len(climbing):  # up to a right sibling that reaches low enough
            done = []
            for height in np.unique(level[climbing]).tolist():
                at = climbing[level[climbing] == height]
                row, right = self.lows[height], node[at] + 1
                right_low = np.where(right < len(row), row[np.minimum(right, len(row) - 1)], np.iinfo(np.int64).max)
                hit = (node[at] % 2 == 0) & (right_low <= target[left[at]])
                node[at[hit]] += 1
                done.append(at[hit])
                node[at[~hit]] //= 2
                level[at[~hit]] += 1
            climbing = np.setdiff1d(climbing, np.concatenate(done))
        while (level > 0).any():  # and down to the first block
            at = np.flatnonzero(level > 0)
            level[at] -= 1
            node[at] *= 2
            for height in np.unique(level[at]).tolist():
                here = at[level[at] == height]
                node[here] += self.lows[height][node[here]] > target[left[here]]
        starts = node * self.block
        self._scan(starts, np.minimum(starts + self.block, len(self.bits)), target[left], found, left)
        return found

    def _scan(self, place, ends, target, found, names) -> None:
        place, going = place.copy(), np.arange(len(names))
        while len(going := going[place[going] < ends[going]]):
            hit = self.excess[place[going]] == target[going]
            found[names[going[hit]]] = place[going[hit]]
            going = going[~hit]
            place[going] += 1


def rebuilt_turns(
    conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, max_rows: int
) -> DataFrame:
    """``conv_id, d, bytes, digest``: the turns of every rebuilt conversation, from d = 1."""
    rows = plain_columns(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.filter(F.col("conv_id").isNotNull()).withColumn("conv_id", F.col("conv_id").cast("bigint"))
    rows = rows.withColumn("role", F.coalesce("role", F.lit(""))).withColumn("text", F.coalesce("text", F.lit("")))
    framed = F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text")
    # two numbers of 60 bits from a digest of the turn
    slim = rows.select(
        "conv_id", "turn", "role", "text", F.octet_length("text").cast("bigint").alias("bytes"), F.md5(framed).alias("digest")
    )
    numbered = running_totals(slim, ["conv_id"], ["turn", "role", "text"], {"i": None}, max_rows)
    numbered = stored(numbered.select("conv_id", "i", "bytes", "digest"), "numbered-turns")
    heads = numbered.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"),
    )
    # at most HEADS - 1 turns of a base reach each of its family's few members
    shared = heads.join(
        numbered.filter(F.col("i") < HEADS).withColumnRenamed("conv_id", "base"), "base"
    ).filter(F.col("i") <= F.col("h"))
    shared = shared.select("conv_id", F.col("i").alias("d"), "bytes", "digest")
    n_shared = shared.groupBy("conv_id").agg(F.count(F.lit(1)).alias("s"))
    own_h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    own = numbered.filter(F.col("i") > own_h).join(n_shared, "conv_id", "left")
    own = own.select("conv_id", (F.col("i") - own_h + F.coalesce("s", F.lit(0))).alias("d"), "bytes", "digest")
    return shared.unionByName(own)


def _pair(digest: Column, d: Column) -> list[Column]:
    """Two numbers that stand for a turn at depth d; sums of them stand for a prefix."""
    placed = F.md5(F.concat_ws(":", d.cast("string"), digest))
    return [F.conv(F.substring(placed, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 17)]


def _name(d: Column, first: Column, second: Column) -> Column:
    return F.concat_ws("-", *(c.cast("string") for c in (d, first, second)))


def _with_span(x: Column, i: Column) -> Column:
    """A step of a path and the chain that it ends, which begins behind the step before."""
    last = F.element_at("steps", F.greatest(i, F.lit(1)).cast("int"))
    weight = F.when(i > 0, (x["n_convs"] - 1) * (x["upto"] - last["upto"])).otherwise(0)
    return F.struct(
        x["k"].alias("k"),
        x["first"].alias("first"),
        x["leaf"].alias("leaf"),
        weight.cast("bigint").alias("weight"),
        F.when(i > 0, last["d"] + 1).otherwise(0).alias("low"),
        F.when(i > 0, last["first"]).alias("up_first"),
    )


def _paths_to_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's sorted paths as parentheses; ``k, spine, leaves, saved`` of each node."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    paths = table["path"].combine_chunks()
    ends = paths.offsets.to_numpy() - paths.offsets[0].as_py()
    nodes = paths.flatten()
    keys = nodes.field("k").dictionary_encode()
    codes = keys.indices.to_numpy()
    sizes = np.diff(ends)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    # a node opens where its path first has it: rows are sorted, so that is the first time
    _, first_at = np.unique(codes, return_index=True)
    opens = np.zeros(len(codes), bool)
    opens[first_at] = True
    opened = np.bincount(row_of[opens], minlength=len(sizes))
    kept = sizes - opened  # what the path shares with the one before
    closed = np.append(sizes[:-1] - kept[1:], sizes[-1])
    runs = np.stack([opened, closed], axis=1).ravel()
    bits = np.repeat(np.tile([True, False], len(sizes)), runs)
    order = np.flatnonzero(opens)
    paren = Parentheses(bits)
    starts = np.flatnonzero(bits)
    closes = paren.findclose(starts)
    # what a node adds to every subtree it is in, counted in the shard of its first id
    leaf = nodes.field("leaf").to_numpy(zero_copy_only=False)
    owner = nodes.field("first").to_numpy()
    rep = table["rep"].to_numpy()
    owned = np.zeros(int(codes.max()) + 1, bool)
    owned[codes[owner == rep[row_of]]] = True
    weight = np.where(owned[codes[order]], nodes.field("weight").to_numpy()[order], 0)
    at_end = np.searchsorted(starts, closes)  # nodes opened up to the closing parenthesis
    # rank of leaf pairs: an opening parenthesis with the closing one right behind it
    pairs = bits[:-1] & ~bits[1:]
    rank = np.append(0, np.cumsum(np.append(pairs, False)[starts] & leaf[order]))
    leaves = rank[at_end] - rank[np.arange(len(starts))]
    total = np.append(0, np.cumsum(weight))
    saved = total[at_end] - total[np.arange(len(starts))]
    spine = np.zeros(int(codes.max()) + 1, bool)
    spine[codes[: sizes[0]]] = True
    spine[codes[len(codes) - sizes[-1] :]] = True
    yield pa.RecordBatch.from_arrays(
        [
            keys.dictionary.take(pa.array(codes[order])),
            pa.array(spine[codes[order]]),
            pa.array(leaves),
            pa.array(saved),
        ],
        ["k", "spine", "leaves", "saved"],
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of a node, in order, joined to texts of bounded length."""
    key, first, ids, size = None, None, [], 0
    done: list[tuple] = []

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))],
            ["k", "first", "ids"],
        )
        done.clear()
        return out

    for batch in batches:
        for k, c in zip(batch.column("k").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key or size > JOINED_CHARS:
                if ids:
                    done.append((key, first, ",".join(ids)))
                key, first, ids, size = k, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if done:
            yield emit()
    if ids:
        done.append((key, first, ",".join(ids)))
        yield emit()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its joined texts in order; only the hash is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, text in zip(batch.column("k").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*done)], ["k", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["k", "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """``k, ends_sha256`` for the rows ``k, conv_id`` of nodes with more than one end.

    A SHA-256 must read its input in order. Ids are joined in many tasks first; the task
    of a node only streams these texts, one at a time.
    """
    sorted_ends = ends.repartitionByRange("k", "conv_id").sortWithinPartitions("k", "conv_id")
    joined = sorted_ends.mapInArrow(_joined, "k string, first bigint, ids string")
    return (
        joined.repartition("k").sortWithinPartitions("k", "first").mapInArrow(_hashed, "k string, ends_sha256 string")
    )


def prefix_nodes(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. Turns are ordered by turn, null first, then by
    role and text, so rows repeated stay turns; null roles and texts are empty. Rows
    without conversation id belong to no conversation. Other columns are not read. An
    empty table has no conversation and gives no row. Texts are read once, as digests;
    a prefix is known by two sums of 60-bit numbers, one per turn and depth.

    A conversation with most of the turns is numbered and summed in chunks. A node that
    many conversations share is one row after partial counts. A path holds only
    branches and ends: b of them on one path need b different conversations whose
    lengths add up to b * b / 2 turns, so a path has at most the square root of twice
    the number of turns.
    """
    turns = rebuilt_turns(conversations, id_col, turn_col, role_col, text_col, max_rows)
    turns = turns.select("conv_id", "d", "bytes", *(c.alias(n) for n, c in zip(("t1", "t2"), _pair(F.col("digest"), F.col("d")))))
    summed = running_totals(turns, ["conv_id"], ["d"], {"k1": "t1", "k2": "t2", "upto": "bytes"}, max_rows)
    prefixes = stored(
        summed.select(
            "conv_id", "d", "bytes", "upto", _name(F.col("d"), F.col("k1"), F.col("k2")).alias("k"),
            _name(F.col("d") - 1, F.col("k1") - F.col("t1"), F.col("k2") - F.col("t2")).alias("up"),
        ),
        "prefixes",
    )
    # turnless conversations too: all ids that the table has
    ids = plain_columns(conversations, conv_id=id_col).filter("conv_id is not null")
    ids = ids.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    lasts = prefixes.groupBy("conv_id").agg(F.max(F.struct("d", "k")).alias("last"))
    ends = stored(
        ids.join(lasts, "conv_id", "left").select("conv_id", F.coalesce("last.k", F.lit(ROOT)).alias("k")), "ends"
    )
    ending = ends.groupBy("k").agg(F.count(F.lit(1)).alias("n_ends"), F.min("conv_id").alias("rep"))
    grown = prefixes.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first"), F.first("d").alias("d"),
        F.first("bytes").alias("bytes"), F.first("upto").alias("upto"), F.first("up").alias("up"),
    )
    top = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    top = top.select(F.lit(ROOT).alias("k"), "n_convs", "first", zero.alias("d"), zero.alias("bytes"), zero.alias("upto"), F.lit(None).cast("string").alias("up"))
    grown = stored(grown.unionByName(top), "prefix-nodes")
    children = grown.groupBy(F.col("up").alias("k")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = grown.join(children, "k", "left").join(ending, "k", "left").fillna(0, ["n_children", "n_ends"])
    nodes = stored(nodes, "counted-nodes")
    folded = nodes.filter("n_children <> 1 or n_ends > 0 or d = 0")

    # the branches and ends on the path of one conversation per end, with what lies between
    reps = ending.select(F.col("rep").alias("conv_id"), F.col("k").alias("end"))
    steps = prefixes.select("conv_id", "k").unionByName(reps.select("conv_id", F.lit(ROOT).alias("k")))
    steps = steps.join(reps, "conv_id").join(
        folded.select("k", "d", "first", "n_convs", "upto", (F.col("n_children") == 0).alias("leaf")), "k"
    )
    step = F.struct("d", "k", "first", "n_convs", "upto", "leaf")
    paths = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    paths = stored(paths.select(F.col("conv_id").alias("rep"), F.transform("steps", _with_span).alias("path")), "trie-paths")
    shards = (
        paths.select("rep", F.col("path.k").alias("order"), "path")
        .repartitionByRange("order").sortWithinPartitions("order").select("rep", "path")
    )
    sums = shards.mapInArrow(
        _paths_to_sums, "k string, spine boolean, leaves bigint, saved bigint"
    )
    sums = stored(sums, "shard-sums")
    merged = sums.filter("spine").groupBy("k").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    sums = sums.filter("not spine").select("k", "leaves", "saved").unionByName(merged)

    # a chain has the first id of the node it ends in: one row per branch or end and first id
    spans = paths.select(F.explode("path").alias("x")).select("x.*").dropDuplicates(["k"])
    spans = spans.join(sums, "k").join(folded.select("k", "d", "upto", "n_convs"), "k")
    spans = spans.select(
        "first", "low", F.col("d").alias("high"), "up_first", "leaves",
        (F.col("saved") - F.col("weight") + (F.col("n_convs") - 1) * F.col("upto")).cast("bigint").alias("base"),
    )
    many = end_hashes(ends.join(ending.filter("n_ends > 1").select("k"), "k", "left_semi").select("k", "conv_id"))
    nodes = nodes.join(many, "k", "left")
    inside = (nodes["first"] == spans["first"]) & (nodes["d"] >= spans["low"]) & (nodes["d"] <= spans["high"])
    sha = F.when(F.col("n_ends") > 1, F.col("ends_sha256")).when(
        F.col("n_ends") == 1, F.sha2(F.col("rep").cast("string"), 256)
    ).otherwise(F.lit(EMPTY_SHA))
    return nodes.join(spans, inside).select(
        nodes["first"].alias("conv_id"), F.col("d").cast("bigint").alias("depth"),
        F.when(F.col("d") == F.col("low"), F.col("up_first")).otherwise(nodes["first"]).alias("parent_conv_id"),
        "n_convs", F.col("n_children").cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("base") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("bytes"))).cast("bigint").alias("saved_tokens"),
        sha.alias("ends_sha256"),
    )
