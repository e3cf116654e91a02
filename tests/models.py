"""Plain sequential models of the operators."""

from __future__ import annotations


def word_split(line: str) -> list[str]:
    words = line.split(" ")
    while len(words) > 1 and words[-1] == "":
        words.pop()
    return [] if words == [""] and line else words


def cycles(times, period):
    """(end, rows so far) of each cycle over one key's times."""
    found, end, total = [], None, 0
    for ms in sorted(times):
        if end is not None and ms > end:
            found.append((end, total))
            end = None
        total += 1
        if end is None:
            end = ms + period
    return found if end is None else [*found, (end, total)]


def bill_check(entries, timeout):
    """Outcomes of one order from (ms, side, status), side 0 = app; timers fire as soon
    as time has passed them."""
    found, app, third, timers = [], None, None, []

    def fire(due):
        nonlocal app, third
        if app is not None and third is not None:
            found.append(("payment_failed", due))
        elif app is not None:
            found.append(("third_timeout", due))
        elif third is not None:
            found.append(("app_timeout", due))
        app = third = None

    for ms, side, status in sorted(entries):
        while timers and timers[0] < ms:
            fire(timers.pop(0))
        if side == 0:
            if third is not None and third == "success":
                found.append(("app_matched", ms))
                third = None
                continue
            app = ms
        else:
            if app is not None and status == "success":
                found.append(("third_matched", ms))
                app = None
                continue
            third = status
        timers = sorted({*timers, ms + timeout})
    while timers:
        fire(timers.pop(0))
    return sorted(found)
