"""Operators on small fixtures: ties, edges, skew, and plan shape."""

import datetime as dt
import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from avspark import dims, schemas
from avspark.functions import geo
from avspark.operators import lookups, performance, quality, routes, sectors, weather
from avspark.plans import catalog
from avspark.session import new_path
from avspark.sources import bindings, files, snapshots


def flights(spark, rows, schema="flight_id string, carrier string, origin string, destination string, "
                                "delay_minutes double, delay_cause string, dep_hour int"):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("is_delayed", (F.col("delay_minutes") >= 15).cast("int"))


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of all flights belong to one carrier and one route."""
    rows = []
    for i in range(3000):
        hot = i % 3 < 2
        rows.append((f"F{i:05d}", "AA" if hot else dims.CARRIERS[i % 10], "ATL" if hot else "LAX",
                     "ORD" if hot else dims.NETWORK_CODES[5 + i % 15], (i * 37 % 900) / 10 if i % 4 else 0.0,
                     "nas" if i % 4 else "none", i % 24))
    return flights(spark, rows).cache()


def test_carrier_report_matches_brute_force_under_skew(skewed):
    rows = skewed.collect()
    for r in performance.on_time_by_carrier(skewed).collect():
        delays = [x.delay_minutes for x in rows if x.carrier == r.carrier]
        late = sum(d >= 15 for d in delays)
        assert (r.total_flights, r.delayed_flights) == (len(delays), late)
        assert r.median_delay == pytest.approx(statistics.median(delays), abs=0.0051)
        assert r.avg_delay_minutes == pytest.approx(statistics.mean(delays), abs=0.0051)
        assert r.on_time_pct == pytest.approx(1 - late / len(delays), abs=0.00006)


def test_carriers_are_sorted_best_first(skewed):
    pct = [r.on_time_pct for r in performance.on_time_by_carrier(skewed).collect()]
    assert pct == sorted(pct, reverse=True)


def test_tied_routes_are_ordered_by_name(spark):
    rows = [(f"F{i}", "AA", o, "ORD", 10.0, "nas", 1) for i, o in enumerate(["SEA", "ATL", "LAX"])]
    got = performance.delay_by_route(flights(spark, rows), 2).collect()
    assert [r.origin for r in got] == ["ATL", "LAX"] and got[0].route == "ATL→ORD"


def test_no_flights(spark):
    empty = flights(spark, [])
    assert performance.on_time_by_carrier(empty).collect() == []
    row = performance.overall_stats(empty).first()
    assert (row.total_flights, row.delayed_flights, row.delay_rate, row.mean_delay_minutes) == (0, 0, 0.0, 0.0)


@pytest.mark.parametrize("n", [1, 7, 1500, 2999, 3000, 10_000])
def test_first_rows_is_exact(skewed, n):
    ids = [r.flight_id for r in skewed.select("flight_id").collect()]
    want = sorted(ids, key=lambda s: hashlib.md5(s.encode()).hexdigest())[:n]
    got = [r.flight_id for r in performance.first_rows(skewed, "flight_id", n).collect()]
    assert sorted(got) == sorted(want)


def test_sweep_equals_separate_summaries(skewed):
    sweep = performance.scale_sweep(skewed, (100, 1000, 5000)).collect()
    for n in (100, 1000, 5000):
        alone = performance.carrier_summary(performance.first_rows(skewed, "flight_id", n)).collect()
        assert {tuple(r[c] for c in ("carrier", "total_flights", "on_time_pct", "avg_delay"))
                for r in sweep if r.row_count == n} == {tuple(r) for r in alone}
    timed = performance.timed_sweep(skewed, (100, 5000))
    assert [t["row_count"] for t in timed] == [100, 5000] and all(t["elapsed_ms"] > 0 for t in timed)


def test_sums_do_not_depend_on_partitioning(skewed):
    one = performance.delay_by_route(skewed.coalesce(1)).collect()
    many = performance.delay_by_route(skewed.repartition(13)).collect()
    assert one == many


def test_cause_shares_add_up(skewed):
    assert sum(r.pct for r in performance.delay_cause_distribution(skewed).collect()) == pytest.approx(100, abs=0.05)
    assert sum(r.share for r in performance.cause_shares(skewed).collect()) == pytest.approx(1, abs=0.005)


def test_list_limits_and_lookup(skewed):
    assert lookups.list_flights(skewed, origin=" atl ", is_delayed=False, limit=5).count() == 5
    for bad in (0, 201):
        with pytest.raises(ValueError):
            lookups.list_flights(skewed, limit=bad)
    assert lookups.find_flight(skewed, "f00001").count() == 1
    assert lookups.find_flight(skewed, "F00001'; --").count() == 0


def test_day_filter_falls_back_to_all(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 2, 5),)],
                               "scheduled_departure timestamp_ntz")
    assert lookups.on_day(df, "2024-01-02").count() == 1
    assert lookups.on_day(df, "2031-01-01").count() == 2


# --- weather ---------------------------------------------------------------

@pytest.fixture(scope="module")
def reports(spark):
    rows = [("ATL", dt.datetime(2024, 1, 1, 5, 0), 0.1), ("ATL", dt.datetime(2024, 1, 1, 8, 0), 0.4),
            ("ATL", dt.datetime(2024, 1, 3, 0, 0), 0.9), ("LAX", dt.datetime(2024, 1, 2, 0, 0), 0.2)]
    return spark.createDataFrame(rows, "airport string, ts timestamp_ntz, weather_impact_score double").withColumn(
        "conditions", F.lit("VMC"))


@pytest.mark.parametrize("airport, at, expected", [
    ("ATL", dt.datetime(2023, 12, 1), 0.1),            # before the first report: first
    ("ATL", dt.datetime(2024, 1, 1, 5, 59), 0.1),      # within the hour
    ("ATL", dt.datetime(2024, 1, 1, 7, 59), 0.1),      # gap: the last one before
    ("ATL", dt.datetime(2024, 1, 1, 8, 0), 0.4),
    ("ATL", dt.datetime(2024, 1, 2, 23, 59), 0.4),
    ("ATL", dt.datetime(2030, 1, 1), 0.9),             # after the last report: last
    ("LAX", dt.datetime(2024, 1, 1), 0.2),
    ("SEA", dt.datetime(2024, 1, 1), None),            # never reported
])
def test_as_of(spark, reports, airport, at, expected):
    keys = spark.createDataFrame([(airport, at)], "airport string, at timestamp_ntz")
    row = weather.as_of(keys, reports, dims.airports(spark), airport="airport", ts="at",
                        values={"weather_impact_score": "impact"}).first()
    assert row.impact == expected


def test_hourly_impact_is_dense(spark, reports):
    grid = weather.hourly_impact(reports.withColumn("hour", F.hour("ts")), dims.airports(spark)).collect()
    assert len(grid) == 50 * 24
    assert {(r.airport, r.hour): r.mean_impact for r in grid}[("ATL", 8)] == 0.4
    assert sum(r.mean_impact for r in grid) == pytest.approx(0.1 + 0.4 + 0.9 + 0.2)


# --- routes ----------------------------------------------------------------

ROUTES = [("SEA", "MIA"), ("BOS", "PHX"), ("DEN", "BOS"), ("LAX", "ATL")]


def test_waypoints(spark, reports):
    df = spark.createDataFrame(ROUTES, "origin string, destination string")
    rows = routes.annotated_waypoints(df, reports, dims.airports(spark)).collect()
    by_route = {}
    for r in sorted(rows, key=lambda r: r.i):
        by_route.setdefault((r.origin, r.destination), []).append(r)
    assert set(by_route) == set(ROUTES) and all(len(v) == 20 for v in by_route.values())
    for (o, d), points in by_route.items():
        miles = [p.distance_from_origin_mi for p in points]
        assert miles == sorted(miles) and miles[0] == 0
        assert (points[0].nearest_airport, points[-1].nearest_airport) == (o, d)
        assert all(0 <= p.weather_impact_score <= 1 for p in points)
    at = {r.code: (math.radians(r.lat), math.radians(r.lon)) for r in dims.airports(spark).collect()}
    (a, x), (b, y) = at["SEA"], at["MIA"]
    miles = 3959 * math.acos(math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(x - y))
    assert by_route[("SEA", "MIA")][-1].distance_from_origin_mi == pytest.approx(miles, rel=0.005)


def test_route_risk_equals_point_by_point(spark, reports):
    """The per-airport shortcut against a plain average over the route's points."""
    df = spark.createDataFrame(ROUTES, "origin string, destination string")
    at = "2024-01-01 09:00:00"
    points = routes.annotated_waypoints(df, reports, dims.airports(spark), at).collect()
    for r in routes.route_risk(df, reports, dims.airports(spark), at).collect():
        scores = [p.weather_impact_score for p in points if (p.origin, p.destination) == (r.origin, r.destination)]
        hit = sum(s > 0.4 for s in scores)
        risk = 0.5 * max(scores) + 0.3 * sum(scores) / 20 + 0.2 * hit / 20
        assert r.risk_score == pytest.approx(risk, abs=0.00051)
        assert r.max_weather_impact >= r.mean_weather_impact
        assert r.weather_impacted_waypoints == hit


def test_path_distance_on_the_ellipsoid(spark):
    df = spark.createDataFrame([("JFK", "LAX")], "origin string, destination string")
    points = routes.route_points(routes.distinct_routes(df, dims.airports(spark)))
    sphere = routes.with_path_distance(points).agg(F.max("path_mi")).first()[0]
    ellipsoid = routes.with_path_distance(points, geo.ellipsoidal_mi).agg(F.max("path_mi")).first()[0]
    assert 0 < abs(sphere - ellipsoid) < 0.005 * sphere


def test_impact_threshold_is_a_parameter(spark, reports):
    df = spark.createDataFrame([("ATL", "DEN")], "origin string, destination string")
    at = "2024-01-01 09:00:00"
    some = routes.route_risk(df, reports, dims.airports(spark), at, threshold=0.39).first()
    none = routes.route_risk(df, reports, dims.airports(spark), at, threshold=0.4).first()
    assert some.weather_impacted_waypoints > 0 == none.weather_impacted_waypoints


# --- sectors ---------------------------------------------------------------

def test_sector_load_wraps_midnight_and_counts_each_flight(spark):
    rows = [("JFK", "LAX", 22, 2475.0)] * 7 + [("HNL", "ANC", 3, 2780.0)]
    df = spark.createDataFrame(rows, "origin string, destination string, dep_hour int, distance_mi double")
    load = sectors.sector_load(df).collect()
    assert len(load) == 480
    hours = {r.hour for r in load if r.positions}
    assert hours == {22, 23, 0, 1, 2, 3}
    assert sum(r.positions for r in load) == 7 * 30        # the Pacific flight is outside the grid
    assert all(r.distinct_flights <= 7 for r in load)
    assert max(r.distinct_flights for r in load) == 7


def test_overload_threshold_and_peak(spark):
    rows = [("JFK", "LAX", 9, 2475.0)] * 3
    df = spark.createDataFrame(rows, "origin string, destination string, dep_hour int, distance_mi double")
    load = sectors.sector_load(df).cache()
    over = sectors.overloaded(load).collect()
    assert [r.aircraft_count for r in over] == sorted((r.aircraft_count for r in over), reverse=True)
    assert all(r.aircraft_count >= 15 and r.alert == "FLOW CONTROL" for r in over)
    peak = sectors.peak(load).first()
    best = max(load.collect(), key=lambda r: (r.positions, -r.sector_id, -r.hour))
    assert (peak.peak_sector, peak.peak_hour, peak.overloaded_count) == (best.sector, best.hour, len(over))
    top = sectors.peak_sector_hours(sectors.load_matrix(load), 3).collect()
    assert top[0]["count"] == best.positions and len(top) == 3


# --- quality and storage ----------------------------------------------------

def test_validation_errors(spark):
    good = ("r", " jfk", "LAX", "2024-01-05T08:00:00", "ua ", "Boeing 737", 8, 2, None, 50)
    cases = {
        "": {}, "origin_format": {"origin": "JF1"}, "origin_unknown": {"origin": "ZZZ"},
        "departure_format": {"scheduled_departure": "2024-01-05 08:00:00"},
        "departure_value": {"scheduled_departure": "2024-02-30T08:00:00"}, "airline": {"airline": "XX"},
        "aircraft_type": {"aircraft_type": "boeing 737"}, "dep_hour": {"dep_hour": 24},
        "day_of_week": {"day_of_week": -1}, "distance_mi": {"distance_mi": 0.9}, "row_limit": {"row_limit": 201},
        "destination_format": {"destination": None},
    }
    names = ["request_id", "origin", "destination", "scheduled_departure", "airline", "aircraft_type", "dep_hour",
             "day_of_week", "distance_mi", "row_limit"]
    schema = ("request_id string, origin string, destination string, scheduled_departure string, airline string, "
              "aircraft_type string, dep_hour int, day_of_week int, distance_mi double, row_limit int")
    rows = [tuple({**dict(zip(names, good)), "request_id": e, **change}[n] for n in names)
            for e, change in cases.items()]
    for r in quality.validate_requests(spark.createDataFrame(rows, schema)).collect():
        expected = [r.request_id] if r.request_id else []
        if r.request_id == "destination_format":
            expected = ["destination_format", "destination_unknown"]
        assert r.errors == expected
        if not expected:
            assert (r.origin, r.airline) == ("JFK", "UA")


def test_key_checks_find_violations(spark):
    df = spark.createDataFrame([("a", "ATL"), ("a", None), ("b", "LAX")], "flight_id string, origin string")
    stored = spark.createDataFrame([("a",), ("z",)], "flight_id string")
    found = {r.rule: r.violations for r in quality.key_checks(df, stored, ["origin"]).collect()}
    assert found == {"flight_id_unique": 1, "origin_not_null": 1, "prediction_flight_exists": 1}


def test_rejects_are_kept(spark, sf_dir):
    asked = bindings.requests(spark, sf_dir)
    good, bad = quality.split_parsable(asked, dims.airports(spark))
    assert good.count() + bad.count() == asked.count()


def test_append_missing_is_idempotent(spark):
    path = new_path(spark, "append")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    more = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    for part in (first, more, more, first):
        files.append_missing(part, path, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_stored_flights_keep_types_and_prune(spark, sf_dir):
    path = new_path(spark, "perf")
    files.write_perf_flights(bindings.perf_flights(spark, sf_dir), path)
    view = files.perf_flights_view(spark, path, "stored_flights")
    types = {f.name: f.dataType for f in view.schema.fields}
    assert types == {f.name: f.dataType for f in schemas.PERF_FLIGHTS.fields}
    plan = spark.sql("SELECT carrier, count(*) FROM stored_flights WHERE year = 1997 AND delay_minutes > 0 "
                     "GROUP BY carrier")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThan(delay_minutes" in plan
    assert "distance_mi" not in plan


def test_predictions_of_a_hot_flight_and_of_none(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "flight_id string, v int")
    stored = spark.createDataFrame([("a", 0.1)] * 50 + [("b", 0.2), ("z", 0.9)], "flight_id string, p double")
    got = sorted(map(tuple, lookups.with_predictions(df, stored).collect()), key=repr)
    assert got == sorted([("a", 1, 0.1)] * 50 + [("b", 2, 0.2), ("c", 3, None)], key=repr)
    assert [r.flight_id for r in lookups.cascade_delete(stored, df.where("v < 3")).collect()] == ["z"]


# --- snapshots ---------------------------------------------------------------

def state(icao, alt=1000.0):
    return (icao, "CS", "X", -90.0, 40.0, alt, 100.0, 90.0, False)


@pytest.fixture(scope="module")
def log(spark):
    states = spark.createDataFrame([state(f"a{i:02d}") for i in range(12)], schemas.AIRCRAFT_STATE)
    # twelve snapshots, one aircraft each, ten seconds apart
    at = (F.substring("icao24", 2, 2).cast("int") * 10 + 1000).cast("bigint")
    return snapshots.to_log(states, at).cache()


@pytest.mark.parametrize("age, rows", [(0, 1), (299, 1), (300, 1), (301, 0)])
def test_latest_snapshot_age_limit(log, age, rows):
    assert snapshots.latest(log, 1110 + age).count() == rows


def test_retention_and_age(log):
    kept = {r.fetched_at for r in snapshots.keep_newest(log).collect()}
    assert kept == {1020 + 10 * i for i in range(10)}
    assert snapshots.age_seconds(log, 1200).first().age_s == 90.0
    assert snapshots.age_seconds(log.where("fetched_at < 0"), 1200).first().age_s == float("inf")


@pytest.mark.parametrize("age, live, expected", [
    (60, True, "cache"), (61, True, "live"), (61, False, "stale"), (300, False, "stale"), (301, False, "fallback"),
])
def test_source_resolution(spark, log, age, live, expected):
    feed = spark.createDataFrame([state("live")], schemas.AIRCRAFT_STATE)
    spare = spark.createDataFrame([state("spare")], schemas.AIRCRAFT_STATE)
    got = snapshots.resolve(log, 1110 + age, feed if live else None, spare).collect()
    assert {r.source for r in got} == {expected} and len(got) == 1


def test_state_json_round_trip(log):
    row = snapshots.from_log(log.where("fetched_at = 1000")).first()
    assert tuple(row)[1:] == state("a00")
    assert '"altitude_ft":3280.84' in log.where("fetched_at = 1000").first().payload


# --- plans -------------------------------------------------------------------

LAZY = [n for n in catalog.QUERIES if n[0] in "apjhgwtu"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product_in_any_plan(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark, sf_dir):
    def scans(name):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line]

    carrier = scans("a1_on_time_by_carrier")
    assert len(carrier) == 1 and "struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string>" in carrier[0]
    assert len(scans("a3_monthly_trends")) == 2
