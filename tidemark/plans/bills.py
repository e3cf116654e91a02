"""The two-slot state machine of an order, row by row; shipped by value."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Halves:
    """An order's waiting halves and the timers they have set.

    A row replaces the half of its side that waits, and sets a timer; a match takes the
    other half away; any timer ends the wait of both.
    """

    def __init__(self, timeout: int, app=None, third=None, status=None, timers=()):
        self.timeout, self.app, self.third, self.status = timeout, app, third, status
        self.timers = sorted(timers)

    def state(self) -> tuple:
        return self.app, self.third, self.status, self.timers

    def fire(self) -> list[tuple[str, int]]:
        """What the first timer reports."""
        due, *self.timers = self.timers
        app, third = self.app is not None, self.third is not None
        self.app = self.third = self.status = None
        if app and third:
            return [("payment_failed", due)]
        return [("third_timeout", due)] if app else [("app_timeout", due)] if third else []

    def row(self, ms: int, side: int, status: str) -> list[tuple[str, int]]:
        """What a row of a side (0 app, 1 third) reports, timers before it included."""
        found = []
        while self.timers and self.timers[0] < ms:
            found += self.fire()
        if side == 0 and self.third is not None and self.status == "success":
            self.third = self.status = None
            return [*found, ("app_matched", ms)]
        if side == 1 and self.app is not None and status == "success":
            self.app = None
            return [*found, ("third_matched", ms)]
        if side == 0:
            self.app = ms
        else:
            self.third, self.status = ms, status
        if ms + self.timeout not in self.timers:
            self.timers.append(ms + self.timeout)
        return found

    def finish(self) -> list[tuple[str, int]]:
        found = []
        while self.timers:
            found += self.fire()
        return found


def reporter(timeout: int):
    """``order_id, outcome, fire_ms`` from sorted rows ``order_id, session, ts_ms, side, status``."""

    def read(batches):
        group, halves = None, None
        for batch in batches:
            out: list[tuple] = []
            names = ("order_id", "session", "ts_ms", "side", "status")
            for order, session, ms, side, status in zip(*(batch.column(n).to_pylist() for n in names)):
                if (order, session) != group:
                    out += [(group[0], *x) for x in halves.finish()] if halves else []
                    group, halves = (order, session), Halves(timeout)
                out += [(order, *x) for x in halves.row(ms, side, status)]
            if out:
                yield _reported(out)
        if halves:
            yield _reported([(group[0], *x) for x in halves.finish()])

    return read


def _reported(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64())
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["order_id", "outcome", "fire_ms"]
    )
