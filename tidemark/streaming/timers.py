"""The state that streams of captures keep, and when it is let go.

Spark asks a processor for its state variables on the driver too, in a Python worker that files added to the
session do not reach; so this module is sent along by value and needs nothing else of the package.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MILLI = 1000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def joined(runs: list[list[int]], gap: int) -> list[list[int]]:
    """Sorted runs [first, last]; those less than a gap apart are one."""
    made: list[list[int]] = []
    for first, last in sorted(runs):
        if made and first - made[-1][1] < gap:
            made[-1][1] = max(made[-1][1], last)
        else:
            made.append([first, last])
    return made


def watch(handle: StatefulProcessorHandle, micros: int, known: int | None) -> int:
    """Have a timer at the first millisecond that is not before ``micros``, or earlier.

    Every question to the handle or a state is a message to the JVM, so the timer is kept with the state, and one that
    has become too early stays: when it goes off the capture is not over and is given the next one.
    """
    wanted = -(-micros // MILLI)
    if known is not None and known <= wanted:
        return known
    if known is not None:
        handle.deleteTimer(known)
    handle.registerTimer(wanted)
    return wanted


class IdlePoint(StatefulProcessor):
    """State of a capture: its runs of events up to the cap, when the page was complete, its last event, and its timer."""

    def __init__(self, gap: int, cap: int, forget: int, needs_complete: bool) -> None:
        self.gap, self.cap, self.forget, self.needs_complete = gap, cap, forget, needs_complete

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("captura", "tramos string, completa bigint, ultimo bigint, hecho boolean, aviso bigint")

    def point(self, runs: list[list[int]], complete: int | None) -> tuple[int, bool]:
        """The quiet moment as far as is known, and whether the cap decides it."""
        limit = runs[0][0] + self.cap
        if not self.needs_complete or complete is not None:
            for at, (_, last) in enumerate(runs):
                rest = max(last + self.gap, complete or 0) if self.needs_complete else last + self.gap
                if at + 1 == len(runs) or runs[at + 1][0] >= rest:
                    return min(rest, limit), rest > limit
        return limit, True

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return
        text, complete, last, done, timer = self.state.get() or ("[]", None, 0, False, None)
        runs = json.loads(text)
        for row in rows:
            last = max(last, row.hasta)
            if row.completa:
                complete = row.desde if complete is None else min(complete, row.desde)
            elif not done:
                runs.append([row.desde, row.hasta])
        if not done and runs:
            runs = joined(runs, self.gap)
            # A run that begins after the cap can only confirm the quiet before it.
            runs = [r for r in runs if r[0] <= runs[0][0] + self.cap]
        timer = watch(self.handle, last + self.forget if done or not runs else self.point(runs, complete)[0], timer)
        self.state.update((json.dumps(runs), complete, last, done, timer))
        return
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self.state.get()
        if kept is None:
            return
        runs, complete, last, done = json.loads(kept[0]), kept[1], kept[2], kept[3]
        now = timerValues.getCurrentWatermarkInMs() * MILLI
        moment, capped = self.point(runs, complete) if runs else (last, False)
        shows = bool(runs) and not done and moment <= now
        end = moment if runs and not done and not shows else max(last, moment) + self.forget
        if end <= now:
            self.state.clear()
        else:
            self.state.update(("[]" if shows else kept[0], complete, last, done or shows, watch(self.handle, end, None)))
        if shows:
            yield Row(clave=key[0], inicio=runs[0][0], reposo=moment, por_tope=capped)

    def close(self) -> None:
        pass


# Events of a capture that its value holds; what is over goes to a list, in texts of as many.
HELD = 1024


def firsts(events: Iterable[list], runs: list[list[int]]) -> list[list]:
    """The earliest event [url, time, row] of every URL in each of the sorted runs."""
    starts = [first for first, _ in runs]
    found: dict[tuple, list] = {}
    for event in events:
        place = event[0], bisect_right(starts, event[1])
        known = found.get(place)
        if known is None or event[1:] < known[1:]:
            found[place] = event
    return list(found.values())


class FirstPerUrl(StatefulProcessor):
    """State of a capture: its runs of events, and for each URL the earliest event of every run.

    Both are in one value, read and written once a batch, so a batch costs a few messages per capture, however many URLs
    it has. A capture of more than ``HELD`` events appends them to a list, which is read when the capture is over or
    when the list has doubled since it was last reduced to first events.
    """

    def __init__(self, idle: int) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("captura", "tramos string, vistas string, fuera bigint, base bigint, aviso bigint")
        self.more = handle.getListState("vistas", "vistas string")

    @staticmethod
    def texts(events: list[list]) -> list[tuple[str]]:
        return [(json.dumps(events[at : at + HELD]),) for at in range(0, len(events), HELD)]

    def listed(self) -> Iterator[list]:
        for (text,) in self.more.get():
            yield from json.loads(text)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return
        runs_text, events_text, away, base, timer = self.state.get() or ("[]", "[]", 0, 0, None)
        runs, events = json.loads(runs_text), json.loads(events_text)
        for row in rows:
            runs.append([row.desde, row.hasta])
            events.append([row.url, row.desde, row.fila])
            if len(events) >= 16 * HELD:
                runs = joined(runs, self.idle)
                # First of a run as far as it is known: if the run grows, the list may hold several, of which the earliest is given.
                events = firsts(events, runs)
                if len(events) > HELD:
                    self.more.appendList(self.texts(events))
                    away, events = away + len(events), []
        runs = joined(runs, self.idle)
        events = firsts(events, runs)
        if len(events) > HELD:
            self.more.appendList(self.texts(events))
            away, events = away + len(events), []
        if away > 2 * base + 16 * HELD:
            reduced = firsts(self.listed(), runs)
            self.more.put(self.texts(reduced))
            away = base = len(reduced)
        timer = watch(self.handle, runs[0][1] + self.idle, timer)
        self.state.update((json.dumps(runs), json.dumps(events), away, base, timer))
        return
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self.state.get()
        if kept is None:
            return
        now = timerValues.getCurrentWatermarkInMs() * MILLI
        runs, events, away = json.loads(kept[0]), json.loads(kept[1]), kept[2]
        over = [r for r in runs if r[1] + self.idle <= now]
        open_ = runs[len(over):]
        if over:
            end = over[-1][1]
            # Runs that have been joined since have one first event between them.
            events = firsts(chain(events, self.listed()) if away else events, runs)
            for url, at, row in events:
                if at <= end:
                    yield Row(clave=key[0], url=url, desde=at, fila=row)
            events = [e for e in events if e[1] > end]
            if away:
                away = 0
                self.more.clear()
                if len(events) > HELD:
                    self.more.put(self.texts(events))
                    away, events = len(events), []
        if open_:
            # The timer that went off may have been of a run that has grown since.
            timer = watch(self.handle, open_[0][1] + self.idle, None)
            self.state.update((json.dumps(open_), json.dumps(events), away, away, timer))
        else:
            self.state.clear()

    def close(self) -> None:
        pass
