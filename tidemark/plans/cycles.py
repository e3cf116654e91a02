"""Task-side readers for cycles of a fixed length over ordered rows.

Spark partitions and sorts; these functions read a partition's Arrow batches in
order and keep the state of one key. They are shipped by value, so executors do
not need the package.
"""

from __future__ import annotations

import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _runs(batches, columns):
    """Yield ``batch, start, end, group, is_new`` for each run of equal columns."""
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[0] = True
        for name in columns:
            # Compare codes: equal values, nulls included, share a code.
            codes = batch.column(name).dictionary_encode("encode").indices.to_numpy(
                zero_copy_only=False
            )
            changed[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(changed)
        ends = np.append(starts[1:], batch.num_rows)
        for start, end in zip(starts.tolist(), ends.tolist()):
            group = tuple(batch.column(name)[start].as_py() for name in columns)
            is_new = group != current
            current = group
            yield batch, start, end, group, is_new


def _batch(rows, schema: pa.Schema):
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
    )


def counter(keys: list[str], out: T.StructType, period: int, carry: bool = False):
    """Report ``keys, end, total`` of every cycle.

    With ``carry``, groups are chunks of a key; a leading row with ``_real`` = 0
    brings the open cycle and total of the chunks before, and says whether the key
    goes on, in which case the last open cycle is left to the next chunk.
    """
    schema = to_arrow_schema(out)
    columns = [*keys, "_chunk"] if carry else keys

    def read(batches):
        group, end_ms, total, goes_on = None, None, 0, False
        found, last_batch = [], None
        for batch, i, stop, new_group, is_new in _runs(batches, columns):
            if batch is not last_batch:
                if found:
                    yield _batch(found, schema)
                    found = []
                last_batch = batch
                times = batch.column("ms").to_pylist()
                sums = np.cumsum(batch.column("n").to_numpy(zero_copy_only=False))
            if is_new:
                if end_ms is not None and not goes_on:
                    found.append((*group, end_ms, total))
                group, end_ms, total, goes_on = new_group[: len(keys)], None, 0, False
                if carry and batch.column("_real")[i].as_py() == 0:
                    end_ms, total = times[i], batch.column("n")[i].as_py()
                    goes_on = batch.column("goes_on")[i].as_py()
                    i += 1
            while i < stop:
                if end_ms is None:
                    end_ms = times[i] + period
                past = bisect_right(times, end_ms, i, stop)
                if past > i:
                    total += int(sums[past - 1] - (sums[i - 1] if i else 0))
                i = past
                if i < stop:
                    found.append((*group, end_ms, total))
                    end_ms = None
        if end_ms is not None and not goes_on:
            found.append((*group, end_ms, total))
        yield _batch(found, schema)

    return read


def stepper(groups: list[str], out: T.StructType, period: int):
    """Reduce a chunk to ``groups, n, upto, exits``.

    A cycle that ends before ``upto[i]`` (the first such ``i``) on entry makes
    ``exits[i]`` the end of the cycle left open. One that ends behind the last
    ``upto`` just stays open.
    """
    schema = to_arrow_schema(out)

    def steps(group, parts, n):
        times = np.concatenate(parts)
        size = len(times)
        following = np.searchsorted(times, times + period, side="right")
        final = np.where(following < size, following, np.arange(size))
        while True:
            further = final[final]
            if np.array_equal(further, final):
                break
            final = further
        # A cycle from before ends by the first time plus the period, so later
        # rows cannot be the first to open one.
        reach = min(int(following[0]), size - 1)
        exits = times[final[: reach + 1]] + period
        ends = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
        return (*group, n, times[ends].tolist(), exits[ends].tolist())

    def read(batches):
        group, parts, n, last_batch, found = None, [], 0, None, []
        for batch, i, stop, new_group, is_new in _runs(batches, groups):
            if batch is not last_batch:
                if found:
                    yield _batch(found, schema)
                    found = []
                last_batch = batch
                times = batch.column("ms").to_numpy()
                counts = batch.column("n").to_numpy()
            if is_new:
                if parts:
                    found.append(steps(group, parts, n))
                group, parts, n = new_group, [], 0
            parts.append(times[i:stop])
            n += int(counts[i:stop].sum())
        if parts:
            found.append(steps(group, parts, n))
        yield _batch(found, schema)

    return read


def chainer(keys: list[str], chunk: str, out: T.StructType):
    """Follow a key's step functions: what open cycle and total meets each chunk."""
    schema = to_arrow_schema(out)

    def read(batches):
        end_ms, total, last_batch, found, held = None, 0, None, [], None
        for batch, i, stop, group, is_new in _runs(batches, keys):
            if batch is not last_batch:
                if found:
                    yield _batch(found, schema)
                    found = []
                last_batch = batch
            if is_new:
                if held:
                    found.append((*held, False))
                end_ms, total, held = None, 0, None
            for at in range(i, stop):
                if held:
                    found.append((*held, True))
                held = (*group, batch.column(chunk)[at].as_py(), end_ms, total)
                total += batch.column("n")[at].as_py()
                upto = batch.column("upto")[at].as_py()
                exits = batch.column("exits")[at].as_py()
                step = 0 if end_ms is None else bisect_right(upto, end_ms)
                if step < len(upto):
                    end_ms = exits[step]
        if held:
            found.append((*held, False))
        yield _batch(found, schema)

    return read
