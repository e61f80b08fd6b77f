"""Flight legs of each aircraft, by a state machine over its reports.

A report in the air opens a leg or goes on with it, a report on the ground ends it, and so does a gap
without reports. Reports wait in a list state until the watermark has passed them and are then taken in
event-time order, so that legs do not depend on how a feed is cut into batches. A timer wakes an
aircraft when its next waiting report or the end of its gap is due.

An element of the list state is a block of reports, because each element is a message of its own between
Spark and the worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LEGS = ("icao24 string, start_us bigint, end_us bigint, reports bigint, top_altitude_m double, ended_by string, "
        "is_open boolean, version bigint")
#: ts, event, airborne, altitude of a report; start, last report, reports, top altitude of a leg.
Report = tuple[int, int, bool, float | None]
Leg = tuple[int, int, int, float | None]

#: Reports of an element of the list state at most, and their layout there; an altitude that is not known is NaN.
BLOCK = 10_000
_LAYOUT = np.dtype([("ts", "<i8"), ("event", "<i8"), ("airborne", "?"), ("altitude", "<f8")])


def blocks(reports: np.ndarray) -> list[tuple[bytes]]:
    """Elements of the list state for ``reports``."""
    return [(reports[at : at + BLOCK].tobytes(),) for at in range(0, len(reports), BLOCK)]


def in_order(parts: list[np.ndarray]) -> np.ndarray:
    """All reports by time, then by event."""
    reports = np.concatenate([np.empty(0, _LAYOUT), *parts])
    return reports[np.lexsort((reports["event"], reports["ts"]))]


def _listed(reports: np.ndarray) -> list[Report]:
    return [(ts, event, airborne, None if altitude != altitude else altitude) for ts, event, airborne, altitude in reports.tolist()]


def advance(leg: Leg | None, reports: list[Report], gap_us: int) -> tuple[list[tuple[Leg, int, str]], Leg | None]:
    """Legs that end within ``reports`` (in order), each with its end and what ended it, and the leg left open."""
    ended = []
    for ts, _, airborne, altitude in reports:
        if leg and ts - leg[1] >= gap_us:
            ended.append((leg, leg[1] + gap_us, "gap"))
            leg = None
        if airborne:
            start, _, n, top = leg or (ts, ts, 0, None)
            leg = (start, ts, n + 1, max((a for a in (top, altitude) if a is not None), default=None))
        elif leg:
            ended.append((leg, ts, "ground"))
            leg = None
    return ended, leg


class LegTracker(StatefulProcessor):
    """Gives each leg once when the watermark has passed its end, and before that, at each change, all
    legs of the aircraft that are not final, flagged as open. The newest ``version`` of an aircraft
    tells its open legs."""

    def __init__(self, gap_s: int):
        self.gap_us = gap_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "reports binary")
        self.known = handle.getValueState(
            "known", "version bigint, start_us bigint, last_us bigint, reports bigint, top_altitude_m double")

    def _state(self) -> tuple[int, Leg | None, list[np.ndarray]]:
        known = self.known.get()
        if known is None:
            return 0, None, []
        version, *leg = known
        waiting = [np.frombuffer(bytes(block), _LAYOUT) for block, in self.waiting.get()]
        return version, None if leg[0] is None else tuple(leg), waiting

    def _due_ms(self, leg: Leg | None, waiting: np.ndarray) -> int | None:
        """When the aircraft's one timer is due: at its next waiting report or the end of its gap."""
        due = [int(waiting["ts"].min())] if len(waiting) else []
        if leg:
            due.append(leg[1] + self.gap_us)
        return min(due) // 1000 if due else None

    def _rows(self, key, version: int, final: list, leg: Leg | None, waiting: np.ndarray) -> Iterator[pd.DataFrame]:
        ended, last = advance(leg, _listed(waiting), self.gap_us)
        if last:
            ended.append((last, last[1] + self.gap_us, "gap"))
        names = [c.split()[0] for c in LEGS.split(", ")]
        rows = [
            (key[0], start, end, n, top, by, is_open, version)
            for legs, is_open in ((final, False), (ended, True)) for (start, _, n, top), end, by in legs]
        if rows:
            columns = dict(zip(names, zip(*rows, strict=True), strict=True))
            yield pd.DataFrame(
                {c: np.array(v, np.int64) for c, v in columns.items() if c in ("start_us", "end_us", "reports", "version")}
                | {"icao24": columns["icao24"], "top_altitude_m": np.array(columns["top_altitude_m"], np.float64),
                   "ended_by": columns["ended_by"], "is_open": np.array(columns["is_open"])}, columns=names)
            return
        # A row without a leg tells that open legs of older versions are no longer so.
        found = pd.DataFrame([(key[0], None, None, None, None, None, None, version)], columns=names)
        yield found.astype({c: "Int64" for c in ("start_us", "end_us", "reports", "version")} | {"top_altitude_m": "float64", "is_open": "boolean"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = []
        for batch in rows:
            part = np.empty(len(batch), _LAYOUT)
            part["ts"], part["event"] = batch["ts_us"].to_numpy(np.int64), batch["event_id"].to_numpy(np.int64)
            part["airborne"], part["altitude"] = batch["airborne"].to_numpy(bool), batch["altitude_m"].to_numpy(np.float64)
            parts.append(part)
        new = np.concatenate([np.empty(0, _LAYOUT), *parts])
        version, leg, before = self._state()
        waiting = in_order([*before, new])
        self.waiting.appendList(blocks(new))
        self.known.update((version + 1, *(leg or (None,) * 4)))
        was, due = self._due_ms(leg, np.concatenate([new[:0], *before])), self._due_ms(leg, waiting)
        if was != due:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(due)
        yield from self._rows(key, version + 1, [], leg, waiting)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        version, leg, before = self._state()
        waiting = in_order(before)
        passed = waiting["ts"] // 1000 < mark
        later = waiting[~passed]
        final, leg = advance(leg, _listed(waiting[passed]), self.gap_us)
        if leg and (leg[1] + self.gap_us) // 1000 < mark:
            final.append((leg, leg[1] + self.gap_us, "gap"))
            leg = None
        if passed.any():
            self.waiting.put(blocks(later)) if len(later) else self.waiting.clear()
        self.known.update((version + 1, *(leg or (None,) * 4)))
        due = self._due_ms(leg, later)  # the timer that went off goes by itself
        if due is not None:
            self.handle.registerTimer(due)
        yield from self._rows(key, version + 1, final, leg, later)

    def close(self) -> None:
        pass
