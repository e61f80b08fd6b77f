"""As-of weather over gaps, at both ends, against a plain search; plans of what reads sources once."""

import datetime as dt
import random

from avspark import dims
from avspark.operators import weather
from avspark.plans import catalog
from avspark.sources import bindings
from avspark.streaming import jobs

T0 = dt.datetime(2019, 1, 1)


def _plain(reports, airport, at):
    """Last report of an hour not after ``at``'s, else the first; reports of one hour: the latest."""
    own = sorted((t, v) for a, t, v in reports if a == airport)
    if at is None or not own:
        return None
    end = at.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    upto = [v for t, v in own if t < end]
    first_hour = own[0][0].replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    return upto[-1] if upto else [v for t, v in own if t < first_hour][-1]


def test_as_of_ends_equals_a_plain_search(spark):
    draw = random.Random(5)
    codes = ["ATL", "BOS", "DEN", "SEA"]
    reports = [(draw.choice(codes[:3]), T0 + dt.timedelta(minutes=draw.randrange(60 * 24 * 400)), i / 1000)
               for i in range(150)]
    # Eight years without a report, then one more.
    reports.append(("ATL", T0 + dt.timedelta(days=3000), 0.9))
    reports.append(("ZZZ", T0, 0.5))
    keys = [(i, draw.choice([*codes, "ZZZ", None]), draw.choice(codes),
             None if i % 17 == 0 else T0 + dt.timedelta(minutes=draw.randrange(-9000, 60 * 24 * 3300)))
            for i in range(400)]
    keys += keys[:5]
    got = weather.as_of_ends(
        spark.createDataFrame(keys, "id int, origin string, destination string, at timestamp_ntz"),
        spark.createDataFrame(reports, "airport string, ts timestamp_ntz, impact double"),
        dims.airports(spark), ts="at",
        ends={"origin": {"impact": "o"}, "destination": {"impact": "d"}},
    )
    known = [r for r in reports if r[0] != "ZZZ"]
    assert sorted((r.id, r.o, r.d) for r in got.collect()) == sorted(
        ((i, _plain(known, o, at), _plain(known, d, at)) for i, o, d, at in keys), key=lambda r: r[0])


def test_as_of_without_reports_or_keys(spark):
    keys = spark.createDataFrame([("ATL", T0)], "airport string, at timestamp_ntz")
    reports = spark.createDataFrame([("ATL", T0, 0.5)], "airport string, ts timestamp_ntz, impact double")
    options = {"airport": "airport", "ts": "at", "values": {"impact": "impact"}}
    assert [r.impact for r in weather.as_of(keys, reports.where("false"), dims.airports(spark), **options).collect()] == [None]
    assert weather.as_of(keys.where("false"), reports, dims.airports(spark), **options).count() == 0


def _plan(spark, sf_dir, name):
    return catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_as_of_makes_no_row_for_each_hour(spark, sf_dir):
    plan = _plan(spark, sf_dir, "j3_asof_weather")
    assert "sequence(" not in plan and "CartesianProduct" not in plan


def test_sources_and_key_checks_scan_once(spark, sf_dir):
    assert _plan(spark, sf_dir, "s11_source_resolution").count("Relation ") <= 4
    checks = _plan(spark, sf_dir, "s15_key_checks")
    assert checks.count("Aggregate [flight_id") == 1, checks


def test_stored_records_give_the_same_weather(spark, sf_dir):
    live, airports = bindings.live_weather(spark, sf_dir), dims.airports(spark)
    few = jobs.static_side(weather.newest_records(live, airports))
    assert few.columns == live.columns and 0 < few.count() <= 50
    rows = lambda df: sorted(map(str, weather.latest_live(df, airports).collect()))
    assert rows(few) == rows(live)
