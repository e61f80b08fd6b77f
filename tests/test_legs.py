"""Legs by the state machine: ground reports, gaps, open legs, order, batches."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from avspark.session import new_path, state_session
from avspark.streaming import jobs, sinks
from avspark.streaming.legs import _LAYOUT, BLOCK, LegTracker, advance, blocks, in_order

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "icao24 string, ts timestamp, event_id long, on_ground boolean, altitude_m double"
GAP = dt.timedelta(minutes=30)


def legs_of(spark, files, gap_s=1800):
    """Legs of reports (aircraft, minute, on_ground, altitude), one landed file and one batch each."""
    own = state_session(spark)
    path, number = new_path(spark, "legs"), 0
    for reports in files:
        rows = []
        for aircraft, minute, on_ground, altitude in reports:
            number += 1
            rows.append((aircraft, T0 + dt.timedelta(minutes=minute), number, on_ground, altitude))
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/feed")
    stream = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/feed")
    sinks.run_to_table(jobs.flight_legs(stream, gap_s), f"{path}/t", f"{path}/c", "update")
    found = sinks.read_legs(spark, f"{path}/t").orderBy("icao24", "leg_start").collect()
    minutes = lambda t: (t - T0).total_seconds() / 60
    return [(r.icao24, minutes(r.leg_start), minutes(r.leg_end), r.reports, r.top_altitude_m, r.ended_by, r.is_open) for r in found]


def test_short_landing_gives_two_legs(spark):
    reports = [("a", 0, False, 10.0), ("a", 5, False, 90.0), ("a", 12, True, 0.0), ("a", 20, False, None), ("a", 30, False, 7.0), ("z", 200, True, 0.0)]
    assert legs_of(spark, [reports]) == [
        ("a", 0, 12, 2, 90.0, "ground", False), ("a", 20, 60, 2, 7.0, "gap", False)]


def test_gap_and_open_legs(spark):
    reports = [("a", 0, False, 1.0), ("a", 29, False, 1.0), ("a", 59, False, 1.0), ("b", 50, True, 1.0), ("b", 58, False, 1.0), ("c", 80, False, 2.0)]
    assert legs_of(spark, [reports]) == [
        ("a", 0, 59, 2, 1.0, "gap", False),       # exactly the gap: a new leg
        ("a", 59, 89, 1, 1.0, "gap", True),       # the mark stands at minute 75
        ("b", 58, 88, 1, 1.0, "gap", True), ("c", 80, 110, 1, 2.0, "gap", True)]


def test_open_legs_of_older_batches_are_replaced(spark):
    """Reports out of order within the watermark, and a leg that closes batches later."""
    files = [[("a", 10, False, 1.0)], [("a", 8, False, 5.0)], [("a", 12, True, 0.0), ("b", 12, False, 3.0)], [("b", 300, True, 0.0)], [("b", 301, True, 0.0)]]
    assert legs_of(spark, files) == [("a", 8, 12, 2, 5.0, "ground", False), ("b", 12, 42, 1, 3.0, "gap", False)]


@pytest.mark.parametrize("size", [1000, 37])
def test_batches_do_not_matter(spark, size):
    rng = random.Random(4)
    at = {a: 0.0 for a in "abcd"}
    reports = []
    for _ in range(250):
        aircraft = rng.choice("aaabcd")
        at[aircraft] += rng.choice([0.5, 2, 9, 31])
        reports.append((aircraft, at[aircraft], rng.random() < 0.2, round(rng.random() * 9000)))
    reports.sort(key=lambda r: r[1])
    reports = [(a, m, g, float(h)) for a, m, g, h in reports]
    want = []
    mark = max(m for _, m, _, _ in reports) - 5
    for aircraft in "abcd":
        mine = [(int(m * 60e6), i, not g, h) for i, (a, m, g, h) in enumerate(reports) if a == aircraft]
        ended, last = advance(None, mine, 1_800_000_000)
        if last:
            ended.append((last, last[1] + 1_800_000_000, "gap"))
        want += [(aircraft, s / 60e6, e / 60e6, n, top, by, not e / 60e6 < mark) for (s, _, n, top), e, by in ended]
    assert legs_of(spark, [reports[i : i + size] for i in range(0, len(reports), size)]) == sorted(want)


def test_callers_session_stays_as_it_is(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert len(legs_of(spark, [[("a", 0, False, 1.0), ("b", 90, True, 1.0)]])) == 1
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, before)
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_blocks_hold_all_reports_in_order():
    n = 2 * BLOCK + 5
    reports = np.array([((7919 * i) % 1000, i, i % 3 == 0, np.nan if i % 5 == 0 else i / 2) for i in range(n)], _LAYOUT)
    stored = blocks(reports)
    assert len(stored) == 3
    back = in_order([np.frombuffer(b, _LAYOUT) for b, in stored])
    assert [r[:2] for r in back.tolist()] == sorted(r[:2] for r in reports.tolist())
    assert len(in_order([])) == 0 and blocks(reports[:0]) == []


class Kept:
    """A state variable or the handle, counting what goes to Spark."""

    def __init__(self):
        self.value, self.elements, self.timers, self.calls = None, [], [], 0

    def get(self):
        return self.value if self.value is not None or not self.elements else iter(self.elements)

    def update(self, value):
        self.value = value

    def appendList(self, new):
        self.elements += new
        self.calls += len(new)

    put = appendList

    def clear(self):
        self.elements = []

    def registerTimer(self, at):
        assert at not in self.timers
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_reports_of_a_batch_are_few_messages_and_one_timer_is_set():
    tracker = LegTracker(1800)
    tracker.waiting, tracker.known, tracker.handle = Kept(), Kept(), Kept()
    feed = lambda at: pd.DataFrame({
        "ts_us": [m * 60_000_000 for m in at], "event_id": range(len(at)), "airborne": True, "altitude_m": 1.0})
    rows = pd.concat(tracker.handleInputRows(("a",), iter([feed(range(100, 3100)), feed(range(3100, 5100))]), None))
    assert tracker.waiting.calls == 1 and len(rows) == 1 and rows["reports"].tolist() == [5000]
    assert tracker.handle.timers == [100 * 60_000]
    list(tracker.handleInputRows(("a",), iter([feed([90])]), None))
    assert tracker.waiting.calls == 2 and tracker.handle.timers == [90 * 60_000]

    class Mark:
        getCurrentWatermarkInMs = staticmethod(lambda: 5000 * 60_000)

    tracker.handle.timers = []  # the engine takes the timer that went off
    tracker.waiting.calls = 0
    elements, tracker.waiting.elements = tracker.waiting.elements, []
    tracker.waiting.get = lambda: iter(elements)
    rows = pd.concat(tracker.handleExpiredTimer(("a",), Mark, None))
    assert tracker.waiting.calls == 1 and tracker.handle.timers == [5000 * 60_000]
    assert rows["reports"].tolist() == [5001] and rows["is_open"].tolist() == [True]
