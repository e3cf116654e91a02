"""Stateful processors driven without Spark: any cut into batches gives the
sequential result."""

from types import SimpleNamespace

from hypothesis import given, settings
from hypothesis import strategies as st

import models
from tidemark.streaming import processors as p


class Handle:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.timers, self.values = set(), {}

    def getValueState(self, name, schema):
        return SimpleNamespace(
            get=lambda: self.values.get(name),
            update=lambda value: self.values.__setitem__(name, value),
            clear=lambda: self.values.pop(name, None),
        )

    def getListState(self, name, schema):
        return SimpleNamespace(
            get=lambda: iter(self.values.get(name, [])),
            put=lambda value: self.values.__setitem__(name, value),
            clear=lambda: self.values.pop(name, None),
        )

    def registerTimer(self, due):
        self.timers.add(due)

    def deleteTimer(self, due):
        self.timers.discard(due)


def drive(processor, batches, time):
    """Micro-batches as Spark runs them: rows first, then the timers that the last
    batch's watermark has passed; at the end time runs out."""
    handle, out, watermark = Handle(), [], 0
    processor.init(handle)
    for batch in [*batches, None]:
        if batch:
            out += processor.handleInputRows(("k",), iter(batch), None)
        for due in sorted(handle.timers):
            if batch is None or due <= watermark:
                if due in handle.timers:
                    handle.timers.discard(due)
                    info = SimpleNamespace(getExpiryTimeInMs=lambda due=due: due)
                    out += processor.handleExpiredTimer(("k",), None, info)
        if batch:
            watermark = max(watermark, max(time(r) for r in batch))
    return sorted(tuple(r)[1:] for r in out)


def cut(items, sizes):
    """The items, in order, as batches of the given sizes; the rest comes last."""
    batches = []
    for size in sizes:
        batches.append(items[:size])
        items = items[size:]
    return [b for b in [*batches, items] if b]


SIZES = st.lists(st.integers(0, 5), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 200), min_size=1, max_size=30), SIZES, st.integers(1, 60))
def test_cycle_counter(times, sizes, period):
    data = [SimpleNamespace(ms=ms) for ms in sorted(times)]
    got = drive(p.CycleCounter(period).named(["k", "end", "n"]), cut(data, sizes), lambda r: r.ms)
    assert got == sorted(models.cycles(times, period))


ENTRY = st.tuples(st.integers(1, 60), st.sampled_from([0, 1]), st.sampled_from(["success", "fail"]))


@settings(max_examples=500, deadline=None)
@given(st.lists(ENTRY, max_size=8), SIZES, st.integers(1, 20))
def test_bill_check(entries, sizes, timeout):
    entries = sorted((ms, side, status if side else "") for ms, side, status in entries)
    data = [SimpleNamespace(ts_ms=ms, side=side, status=status) for ms, side, status in entries]
    # Rows of one time stay in one batch, as their order decides.
    batches = cut(data, sizes)
    for earlier, later in zip(batches, batches[1:]):
        while later and earlier and later[0].ts_ms == earlier[-1].ts_ms:
            later.insert(0, earlier.pop())
    got = drive(
        p.BillCheck(timeout).named(["k", "outcome", "fire"]),
        [b for b in batches if b],
        lambda r: r.ts_ms,
    )
    assert got == models.bill_check(entries, timeout)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**15), max_size=30), SIZES, st.integers(1, 6))
def test_average_every_n(times, sizes, n):
    times.sort()
    data = [SimpleNamespace(ms=ms) for ms in times]
    got = drive(p.AverageEveryN(n).named(["k", "nth", "avg"]), cut(data, sizes), lambda r: r.ms)
    assert got == [(i, sum(times[:i]) // i) for i in range(n, len(times) + 1, n)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 40), SIZES, st.integers(1, 7))
def test_full_chunks(count, sizes, size):
    held = SimpleNamespace(fieldNames=lambda: ["id"])
    data = [{"id": i} for i in range(count)]
    processor = p.FullChunks(held, ["id"], size).named(["k", "chunk", "id"])
    got = drive(processor, cut(data, sizes), lambda r: r["id"])
    assert got == [(i // size, i) for i in range(count - count % size)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=20), SIZES)
def test_previous_action(actions, sizes):
    data = [SimpleNamespace(ms=i // 2, id=i, action=a) for i, a in enumerate(actions)]
    processor = p.PreviousAction().named(["k", "id", "ms", "action", "prev"])
    got = drive(processor, cut(data, sizes), lambda r: r.ms)
    assert got == [(i, i // 2, actions[i], actions[i - 1]) for i in range(1, len(actions))]
