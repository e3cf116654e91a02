"""State and timers of the keyed stream operators.

Within a micro-batch Spark hands over rows before it fires timers, so rows are
sorted, and what ends among them is closed on the spot. A timer at T leaves rows at
T in time. The processors are shipped by value, so executors do not need the
package.
"""

from __future__ import annotations

import pickle
import sys
from array import array
from bisect import bisect_right
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from tidemark.plans.bills import Halves
from tidemark.streaming.blocks import ROWS_PER_BLOCK, from_block, sorted_rows, to_block

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _sorted_times(rows) -> list[int]:
    """Times in order; packed, since a batch may hold many rows of a key."""
    times = np.frombuffer(array("q", (row.ms for row in rows)), dtype=np.int64)
    return np.sort(times).tolist()


class Processor(StatefulProcessor):
    """Base: ``row`` builds output rows once the output columns are set."""

    def named(self, columns: list[str]) -> Processor:
        self.columns = columns
        return self

    def init(self, handle):
        self.row = Row(*self.columns)
        self.handle = handle

    def close(self):
        pass


class CycleCounter(Processor):
    """Total rows of a key at the end of each cycle."""

    def __init__(self, period: int):
        self.period = period

    def init(self, handle):
        super().init(handle)
        self.cycle = handle.getValueState("cycle", "end_ms bigint, total bigint")

    def handleInputRows(self, key, rows, timerValues):
        times = _sorted_times(rows)
        open_end, total = self.cycle.get() or (None, 0)
        end_ms, i = open_end, 0
        while i < len(times):
            if end_ms is None:
                end_ms = times[i] + self.period
            past = bisect_right(times, end_ms, i)
            total += past - i
            i = past
            if i < len(times):
                yield self.row(*key, end_ms, total)
                end_ms = None
        if end_ms != open_end:
            if open_end is not None:
                self.handle.deleteTimer(open_end)
            self.handle.registerTimer(end_ms)
        self.cycle.update((end_ms, total))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end_ms, total = self.cycle.get()
        if end_ms == expiredTimerInfo.getExpiryTimeInMs():
            self.cycle.update((None, total))
            yield self.row(*key, end_ms, total)


class AverageEveryN(Processor):
    """Mean time of all rows so far, at every n-th row."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle):
        super().init(handle)
        self.totals = handle.getValueState("totals", "count bigint, total decimal(38,0)")

    def handleInputRows(self, key, rows, timerValues):
        count, total = self.totals.get() or (0, 0)
        total = int(total)
        for ms in _sorted_times(rows):
            count, total = count + 1, total + ms
            if count % self.n == 0:
                yield self.row(*key, count, total // count if total >= 0 else -(-total // count))
        self.totals.update((count, Decimal(total)))


class BillCheck(Processor):
    """Waits a fixed time for the other side of an order."""

    def __init__(self, timeout: int):
        self.timeout = timeout

    def init(self, handle):
        super().init(handle)
        self.halves = handle.getValueState(
            "halves", "app_ms bigint, third_ms bigint, status string, timers array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues):
        halves = Halves(self.timeout, *(self.halves.get() or ()))
        before = list(halves.timers)
        for ms, side, status in sorted((r.ts_ms, r.side, r.status or "") for r in rows):
            for outcome in halves.row(ms, side, status):
                yield self.row(*key, *outcome)
        for due in set(before).difference(halves.timers):
            self.handle.deleteTimer(due)
        for due in set(halves.timers).difference(before):
            self.handle.registerTimer(due)
        self.halves.update(halves.state())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        app, third, status, timers = self.halves.get()
        due = expiredTimerInfo.getExpiryTimeInMs()
        halves = Halves(self.timeout, app, third, status, [due])
        outcomes = halves.fire()
        left = [t for t in timers if t != due]
        if left:
            self.halves.update((None, None, None, left))
        else:
            self.halves.clear()
        for outcome in outcomes:
            yield self.row(*key, *outcome)


def _nulls_first(values) -> tuple:
    """A sort key in which nulls come first, as in Spark's own order."""
    return tuple((value is not None, value) for value in values)


class FullChunks(Processor):
    """Holds rows until a buffer is full."""

    def __init__(self, held: StructType, order: list[str], size: int):
        self.held_schema, self.order, self.size = held, order, size

    def init(self, handle):
        super().init(handle)
        self.held = handle.getListState("held", self.held_schema)
        self.chunks = handle.getValueState("chunks", "done bigint")

    def handleInputRows(self, key, rows, timerValues):
        names = self.held_schema.fieldNames()
        places = [names.index(name) for name in self.order]
        arrived = [tuple(row[name] for name in names) for row in rows]
        arrived.sort(key=lambda values: _nulls_first(values[i] for i in places))
        buffer = [tuple(values) for values in self.held.get()] + arrived
        (done,) = self.chunks.get() or (0,)
        full = len(buffer) // self.size
        for i, values in enumerate(buffer[: full * self.size]):
            yield self.row(*key, done + i // self.size, *values)
        rest = buffer[full * self.size :]
        if rest:
            self.held.put(rest)
        else:
            self.held.clear()
        self.chunks.update((done + full,))


class FullChunkBlocks(FullChunks):
    """:class:`FullChunks` on rows in blocks: they are never objects of their own."""

    def init(self, handle):
        Processor.init(self, handle)
        self.held = handle.getValueState("held", "block binary")
        self.chunks = handle.getValueState("chunks", "done bigint")

    def handleInputRows(self, key, rows, timerValues):
        arrived = sorted_rows(pa.concat_tables([from_block(row.block) for row in rows]), self.order)
        (held,) = self.held.get() or (None,)
        buffer = pa.concat_tables([from_block(held), arrived]) if held else arrived
        (done,) = self.chunks.get() or (0,)
        full = len(buffer) // self.size
        for start in range(0, full * self.size, ROWS_PER_BLOCK):
            stop = min(start + ROWS_PER_BLOCK, full * self.size)
            numbers = done + np.arange(start, stop, dtype=np.int64) // self.size
            block = buffer.slice(start, stop - start).append_column("chunk", pa.array(numbers))
            yield self.row(*key, to_block(block))
        rest = buffer.slice(full * self.size)
        if len(rest):
            self.held.update((to_block(rest),))
        else:
            self.held.clear()
        self.chunks.update((done + full,))


class SeenWatermarks(Processor):
    """Reports arrivals and the watermark they meet."""

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in rows:
            yield self.row(*key, "arrival", row.user, row.ms)
            yield self.row(*key, "watermark", row.user, watermark)


class PreviousAction(Processor):
    """Pairs each action with the one before."""

    def init(self, handle):
        super().init(handle)
        self.last = handle.getValueState("last", "action string")

    def handleInputRows(self, key, rows, timerValues):
        (previous,) = self.last.get() or (None,)
        moves = ((row.ms, row.id, row.action) for row in rows)
        for ms, at, action in sorted(moves, key=_nulls_first):
            if previous is not None:
                yield self.row(*key, at, ms, action, previous)
            previous = action
        self.last.update((previous,))


def _pickled(rows: list[tuple], size: int = 10_000) -> list[tuple[bytes]]:
    return [(pickle.dumps(rows[i : i + size]),) for i in range(0, len(rows), size)]


class ControlledMatch(Processor):
    """Holds actions and patterns until time has passed them, then follows them in order."""

    def __init__(self, user: str, tie: str):
        self.user_type, self.tie_type = user, tie

    def init(self, handle):
        super().init(handle)
        self.waiting = handle.getListState("waiting", "block binary")  # rows pickled together
        self.due = handle.getValueState("due", "ms bigint")
        self.rule = handle.getValueState("rule", "action1 string, action2 string")
        self.last = handle.getMapState("last", f"user {self.user_type}", "action string")

    def _wait(self, due):
        """One timer, at the first time that waits."""
        (before,) = self.due.get() or (None,)
        if before is not None and (due is None or due != before):
            self.handle.deleteTimer(before)
        if due is not None and due != before:
            self.handle.registerTimer(due)
        self.due.update((due,))

    def handleInputRows(self, key, rows, timerValues):
        new = [(r.ms, r.kind, r.id, r.user, r.action, r.action1, r.action2) for r in rows if r.ms is not None]
        if new:
            self.waiting.appendList(_pickled(new))
            (due,) = self.due.get() or (None,)
            first = min(row[0] for row in new)
            self._wait(first if due is None else min(due, first))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        (due,) = self.due.get() or (None,)
        if due != expiredTimerInfo.getExpiryTimeInMs():
            return
        passed = timerValues.getCurrentWatermarkInMs()
        held = [row for (block,) in self.waiting.get() for row in pickle.loads(block)]
        ready = sorted((r for r in held if r[0] <= passed), key=_nulls_first)
        left = [r for r in held if r[0] > passed]
        rule = self.rule.get()
        lasts = {}  # of the users met, each read and written once
        for ms, kind, at, user, action, action1, action2 in ready:
            if kind == 0:
                rule = (action1, action2)
                continue
            name = repr(user)
            if name not in lasts:
                lasts[name] = (user, self.last.getValue((user,)) if self.last.containsKey((user,)) else None)
            last = lasts[name][1]
            if last is not None and rule is not None and (last[0], action) == tuple(rule):
                yield self.row(*key, user, at, *rule)
            lasts[name] = (user, (action,))
        for user, last in lasts.values():
            self.last.updateValue((user,), last)
        if rule is not None:
            self.rule.update(tuple(rule))
        if left:
            self.waiting.put(_pickled(left))
        else:
            self.waiting.clear()
        self.due.update((None,))
        self._wait(min((r[0] for r in left), default=None))
