"""Streams against their batch results, late data, and state transitions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from avspark import schemas
from avspark.session import new_path
from avspark.sources import bindings, snapshots
from avspark.streaming import jobs, sinks

T0 = dt.datetime(2024, 1, 1, 0, 0)


def land(df, path):
    """One landed file per call."""
    df.coalesce(1).write.mode("append").parquet(path)


def feed(spark, path):
    return jobs.event_stream(spark, path, files_per_batch=1)


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    """The event feed in six files, in time order."""
    path = new_path(spark, "landed")
    events = bindings.table(spark, sf_dir, "events")
    for day in range(0, 30, 5):
        low, high = (f"timestamp_ntz'2024-01-01' + interval {d} days" for d in (day, day + 5))
        land(events.where(f"ts >= {low} AND ts < {high}"), path)
    return path


def run(spark, stream, mode="append"):
    path = new_path(spark, "stream")
    query = sinks.run_to_table(stream, f"{path}/t", f"{path}/c", mode)
    return f"{path}/t", query


def batch_positions(spark, sf_dir):
    return jobs.position_stream(bindings.table(spark, sf_dir, "events"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stateless_stream_equals_batch(spark, sf_dir, landed):
    table, query = run(spark, jobs.position_stream(feed(spark, landed)))
    assert len({p["batchId"] for p in query.recentProgress}) >= 6
    assert rows(sinks.read_appended(spark, table)) == rows(batch_positions(spark, sf_dir))


def test_latest_state_equals_batch(spark, sf_dir, landed):
    table, _ = run(spark, jobs.latest_state(jobs.position_stream(feed(spark, landed))), "update")
    got = sinks.read_updated(spark, table, ["icao24"])
    assert rows(got) == rows(jobs.latest_state(batch_positions(spark, sf_dir)))


def test_windowed_counts_equal_batch(spark, sf_dir, landed):
    positions = jobs.position_stream(feed(spark, landed))
    batch = batch_positions(spark, sf_dir)
    table, _ = run(spark, jobs.band_kpis(positions), "update")
    assert rows(sinks.read_updated(spark, table, ["hour_start", "band"])) == rows(jobs.band_kpis(batch))
    table, _ = run(spark, jobs.sliding_sector_load(positions), "update")
    assert rows(sinks.read_updated(spark, table, ["window_start", "sector_id"])) == rows(
        jobs.sliding_sector_load(batch))


def events(spark, reports):
    """(event_id, minute, user_id) as events inside the box and off the ground."""
    data = [(i * 97 * 11 + 1, T0 + dt.timedelta(minutes=m), u, "view", 50.0 + i, '{"k": 5}')
            for i, m, u in reports]
    return spark.createDataFrame(data, schemas.TABLES["events"])


def in_box_ids(spark, count):
    """Small numbers whose derived position lies inside the live box."""
    found, i = [], 0
    candidates = jobs.position_stream(events(spark, [(n, 0, 1) for n in range(400)]))
    good = {(r.event_id - 1) // (97 * 11) for r in candidates.where("NOT on_ground").collect()}
    while len(found) < count:
        if i in good:
            found.append(i)
        i += 1
    return found


def test_late_rows_are_refused_and_counted(spark):
    """Row by row, also where rows of one hour meet in one task, and over several runs."""
    ids = in_box_ids(spark, 9)
    path = new_path(spark, "late")
    for reports in ([(ids[0], 10, 1), (ids[1], 200, 1)], [(i, 20, 1) for i in ids[2:6]], [(ids[6], 190, 1), (ids[7], 400, 1)], [(ids[8], 30, 1)]):
        land(events(spark, reports), f"{path}/feed")
        sinks.run_to_table(jobs.hourly_counts(jobs.position_stream(feed(spark, f"{path}/feed"))), f"{path}/t", f"{path}/c", "update")
    found = sinks.read_hourly_counts(spark, f"{path}/t").collect()
    # The reports of minutes 20 and 30 came after their hour had closed.
    assert {r.hour_start.hour: (r.reports, r.is_open) for r in found} == {0: (1, False), 3: (2, False), 6: (1, True)}
    assert {r.late_rows_refused for r in found} == {5}


def test_repeats_are_removed_across_batches(spark):
    a, b = in_box_ids(spark, 2)
    path = new_path(spark, "repeats")
    for reports in ([(a, 1, 7), (b, 2, 7)], [(b, 2, 7)], [(a, 1, 7)]):
        land(events(spark, reports), path)
    table, _ = run(spark, jobs.without_repeats(jobs.position_stream(feed(spark, path))).select("icao24", "ts"))
    assert sinks.read_appended(spark, table).count() == 2


def test_repeats_are_combined_before_the_shuffle(spark):
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 'hot', concat('a', id % 50)) AS icao24",
        "timestamp_seconds(if(id % 3 = 0, 0, id % 7)) AS ts", "id AS event_id")
    distinct = rows.select("icao24", "ts").distinct().count()
    assert jobs.combined_repeats(rows).count() <= 4 * distinct
    # A small memory lets more copies pass and still loses nothing.
    few = jobs.combined_repeats(rows, 2)
    assert few.select("icao24", "ts").distinct().count() == distinct and few.count() > 4 * distinct
    assert jobs.combined_repeats(rows.where("false")).count() == 0


def test_repeats_have_one_stateful_step(spark):
    path = new_path(spark, "plan")
    a, = in_box_ids(spark, 1)
    land(events(spark, [(a, 1, 7)]), path)
    plan = jobs.without_repeats(jobs.position_stream(feed(spark, path)))._jdf.queryExecution().analyzed().toString()
    assert plan.count("DeduplicateWithinWatermark") == 1 and plan.count("MapInArrow") == 1


def test_freshness_transitions(spark):
    ids = in_box_ids(spark, 5)
    path = new_path(spark, "fresh")
    for reports in ([(ids[0], 0, 1)], [(ids[1], 1, 1)], [(ids[2], 5, 1)], [(ids[3], 11, 1)], [(ids[4], 60, 2)]):
        land(events(spark, reports), path)
    table, _ = run(spark, jobs.freshness(jobs.position_stream(feed(spark, path))))
    got = sinks.read_appended(spark, table).where("icao24 = '000001'").orderBy("ts_ms", "status", "age_s").collect()
    minutes = [(r.ts_ms // 60_000 % 1440, r.age_s, r.status) for r in got]
    assert minutes == [
        (0, 0.0, "FRESH"), (1, 60.0, "FRESH"), (5, 300.0, "EXPIRED"), (5, 240.0, "STALE"),
        (11, 300.0, "EXPIRED"), (11, 360.0, "EXPIRED")]


def test_rows_do_not_depend_on_files_or_batches(spark, sf_dir, landed):
    """One file, a folder of part files under the table's name, and several batches in time order."""
    parts = new_path(spark, "parts")
    bindings.table(spark, sf_dir, "events").repartition(8).write.parquet(f"{parts}/events.parquet")
    whole = jobs.event_stream(spark, sf_dir, "events.parquet")
    folder = jobs.event_stream(spark, parts, "events.parquet")
    for job in (lambda s: s, jobs.freshness):
        results = [rows(sinks.read_appended(spark, run(spark, job(jobs.position_stream(s)))[0]))
                   for s in (whole, folder, feed(spark, landed))]
        assert results[0] and results[0] == results[1] == results[2]


def test_snapshots_of_one_second_stay_apart(spark):
    a, b = in_box_ids(spark, 2)
    path = new_path(spark, "second")
    for report in ((a, 5, 1), (b, 5, 2)):
        land(events(spark, [report]), f"{path}/feed")
    sinks.run_snapshots(jobs.position_stream(feed(spark, f"{path}/feed")), f"{path}/log", f"{path}/c")
    assert snapshots.read_log(spark, f"{path}/log").select("number").distinct().count() == 2


def test_snapshot_retention_on_disk(spark):
    ids = in_box_ids(spark, 12)
    path = new_path(spark, "retention")
    for n, i in enumerate(ids):
        land(events(spark, [(i, n, n)]), f"{path}/feed")
    sinks.run_snapshots(jobs.position_stream(feed(spark, f"{path}/feed")), f"{path}/log", f"{path}/c", keep=4)
    log = snapshots.read_log(spark, f"{path}/log")
    kept = sorted(r.fetched_at for r in log.select("fetched_at").distinct().collect())
    start = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    assert kept == [start + 60 * n for n in range(8, 12)]
    assert snapshots.latest(log, start + 660).count() == 1
    assert len(os.listdir(f"{path}/log/data")) <= 9


def test_replayed_batch_is_not_counted_twice(spark, landed):
    """A batch written again replaces its own folder."""
    positions = jobs.position_stream(feed(spark, landed))
    path = new_path(spark, "replay")
    sinks.run_to_table(positions, f"{path}/t", f"{path}/c1")
    first = sinks.read_appended(spark, f"{path}/t").count()
    sinks.run_to_table(positions, f"{path}/t", f"{path}/c2")
    assert sinks.read_appended(spark, f"{path}/t").count() == first
