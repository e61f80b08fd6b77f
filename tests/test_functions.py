"""Column rules at their boundaries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions import geo, positions, weather
from avspark.functions.numeric import round_dp, tenths
from avspark.operators import sectors

JFK, LAX = (40.6413, -73.7781), (33.9425, -118.4081)


def one(spark, **columns):
    """Evaluate columns over a single row."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def lits(*values):
    return [F.lit(float(v)) for v in values]


def test_haversine_known_distance_and_symmetry(spark):
    row = one(spark, there=geo.haversine_mi(*lits(*JFK, *LAX)), back=geo.haversine_mi(*lits(*LAX, *JFK)),
              same=geo.haversine_mi(*lits(*JFK, *JFK)))
    assert 2400 < row.there < 2550
    assert row.there == pytest.approx(row.back)
    assert row.same == 0


def test_ellipsoidal_distance(spark):
    rows = dims.airport_pairs(spark, dims.AIRPORTS).select(
        geo.haversine_mi(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")).alias("h"),
        geo.ellipsoidal_mi(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")).alias("e"),
    ).collect()
    assert len(rows) == 50 * 49
    assert all(abs(r.h - r.e) / r.e < 0.0056 for r in rows)
    assert one(spark, d=geo.ellipsoidal_mi(*lits(*JFK, *JFK))).d == 0
    # a quarter of the equator is an arc of the WGS-84 major radius
    quarter = one(spark, d=geo.ellipsoidal_mi(*lits(0, 0, 0, 90))).d
    assert quarter == pytest.approx(math.pi / 2 * 6_378_137 / 1609.344, rel=1e-9)


def test_flight_minutes_truncates(spark):
    row = one(spark, zero=ff.flight_minutes(F.lit(0.0)), an_hour=ff.flight_minutes(F.lit(520.0)),
              part=ff.flight_minutes(F.lit(525.0)))
    assert (row.zero, row.an_hour, row.part) == (40, 100, 100)


def test_delay_rules_at_thresholds(spark):
    delays = [0.0, 14.9, 15.0, 59.9, 60.0]
    rows = spark.createDataFrame([(d,) for d in delays], "d double").select(
        ff.is_delayed(F.col("d")).alias("late"), ff.delay_band(F.col("d")).alias("band"),
        ff.delay_status(F.col("d")).alias("status"),
        ff.cause_or_none(F.col("d"), F.lit("nas")).alias("cause"),
    ).collect()
    assert [r.late for r in rows] == [False, False, True, True, True]
    assert [r.band for r in rows] == ["on_time", "on_time", "delayed", "delayed", "severe"]
    assert [r.status for r in rows] == ["On-time", "On-time", "+15 min", "+60 min", "+60 min"]
    assert [r.cause for r in rows] == ["none", "nas", "nas", "nas", "nas"]


def test_rounding_is_half_up(spark):
    row = one(spark, a=round_dp(F.lit(1.005), 2), b=round_dp(F.lit(2.5), 0), t=tenths(F.lit(12.3)))
    assert (row.a, row.b, row.t) == (1.01, 3.0, 123)


def test_congestion_and_encoding(spark):
    def score(o, d, h, **kw):
        return ff.congestion_score(F.lit(o), F.lit(d), F.lit(h), **kw)

    row = one(spark, all_=score("ORD", "JFK", 8), none=score("BOS", "SEA", 12), peak=score("BOS", "SEA", 16),
              edge=score("BOS", "SEA", 10), jitter=score("ORD", "JFK", 8, jitter=True))
    assert (row.all_, row.none, row.peak, row.edge) == (0.8, 0.0, 0.3, 0.0)
    assert 0.8 <= row.jitter <= 0.85
    codes = one(spark, **{f"c{i}": ff.encode_aircraft(F.lit(name)) for i, name in enumerate(
        ["Airbus A320", "Airbus A321", "Boeing 737", "Boeing 777", "Concorde"])})
    assert list(codes) == [0, 1, 2, 3, 0]


def test_blend_and_labels(spark):
    none = F.lit(None).cast("double")
    row = one(spark, both=ff.blended_probability(F.lit(0.5), F.lit(1.0)),
              weather=ff.blended_probability(none, F.lit(0.4)),
              hi=ff.confidence(F.lit(0.1)), lo=ff.confidence(none),
              high=ff.risk_label(F.lit(0.61)), mod=ff.risk_label(F.lit(0.6)), low=ff.risk_label(F.lit(0.35)),
              wait=ff.expected_delay(F.lit(0.65)))
    assert tuple(row) == (0.65, 0.4, "high", "low", "HIGH", "MODERATE", "LOW", 58.5)


def test_altitude_bands_and_fallback(spark):
    def band(m):
        return positions.altitude_band(F.lit(float(m)))

    row = one(spark, a=band(1523.9), b=band(1524), c=band(7619.9), d=band(7620),
              rgba=positions.altitude_colour(F.lit(0.0)))
    assert tuple(row)[:4] == ("low", "mid", "mid", "high")
    assert row.rgba == [30, 144, 255, 200]
    null = F.lit(None).cast("double")
    best = one(spark, geo_=positions.best_altitude(F.lit(5.0), F.lit(9.0)),
               zero=positions.best_altitude(F.lit(0.0), F.lit(9.0)),
               missing=positions.best_altitude(null, F.lit(9.0)), nothing=positions.best_altitude(null, null))
    assert tuple(best) == (5.0, 9.0, 9.0, 0.0)


CLEAR = dict(wind=10.0, vis=16.0, precip=0.0, cloud=20.0, code=0)


@pytest.mark.parametrize("change, expected", [
    ({}, 0.0), ({"wind": 25.0}, 0.0), ({"wind": 25.1}, 0.3), ({"vis": 4.827}, 0.3), ({"vis": 4.828}, 0.0),
    ({"precip": 0.1}, 0.0), ({"precip": 0.11}, 0.2), ({"cloud": 80.0}, 0.0), ({"cloud": 81.0}, 0.1),
    ({"code": 95}, 0.4), ({"code": 83}, 0.0),
    ({"wind": 35.0, "vis": 1.5, "precip": 5.0, "cloud": 95.0, "code": 95}, 1.0),
    ({"wind": None, "vis": None, "precip": None, "cloud": None, "code": None}, 0.0),
])
def test_live_risk_thresholds(spark, change, expected):
    w = {**CLEAR, **change}
    types = {"code": "int"}
    score = weather.risk_score(*[F.lit(w[k]).cast(types.get(k, "double")) for k in CLEAR])
    assert one(spark, s=score).s == expected


def test_conditions_and_impact(spark):
    def cond(v, c):
        return weather.conditions(F.lit(float(v)), F.lit(c))

    row = one(spark, a=cond(3, 1000), b=cond(2.9, 1000), c=cond(3, 999), d=cond(0.9, 5000), e=cond(1, 500))
    assert tuple(row) == ("VMC", "MVMC", "MVMC", "IMC", "MVMC")
    score = one(spark, best=weather.impact_score(*lits(10, 5000, 0)), worst=weather.impact_score(*lits(0, 0, 50)))
    assert tuple(score) == (0.0, 1.0)


def test_great_circle_ends_single_point_and_coincident(spark):
    df = spark.createDataFrame([("a", *JFK, *LAX), ("b", *JFK, *JFK)],
                               "k string, o_lat double, o_lon double, d_lat double, d_lon double")
    rows = geo.along_great_circle(df, 20).orderBy("k", "i").collect()
    a, b = rows[:20], rows[20:]
    assert (a[0].lat, a[0].lon) == pytest.approx(JFK) and (a[-1].lat, a[-1].lon) == pytest.approx(LAX)
    assert all((r.lat, r.lon) == pytest.approx(JFK) for r in b) and len(b) == 20
    assert [r.frac for r in a] == pytest.approx([i / 19 for i in range(20)])
    single = geo.along_great_circle(df, 1).collect()
    assert len(single) == 2 and single[0].frac == 0.0


def test_sector_edges_and_range_join(spark):
    rng = random.Random(5)
    points = [(25.0, -125.0), (50.0, -100.0), (49.999, -65.0), (24.999, -100.0), (31.25, -113.0),
              (21.3245, -157.9251), (61.1743, -149.9963)]
    points += [(rng.uniform(20, 55), rng.uniform(-130, -60)) for _ in range(2000)]
    df = spark.createDataFrame(points, "latitude double, longitude double").cache()
    got = {(r.latitude, r.longitude): r.sector_id for r in sectors.in_sectors(df).collect()}
    assert got[(25.0, -125.0)] == 0 and got[(31.25, -113.0)] == 6
    assert [got[p] for p in points[1:4]] == [None] * 3
    assert got[points[5]] is None and got[points[6]] is None
    grid = sectors.sector_grid(spark).collect()
    assert len(grid) == 20 and grid[7].sector == "S07(R1C2)"
    for p, cell in got.items():
        inside = [g.sector_id for g in grid if g.lat_lo <= p[0] < g.lat_hi and g.lon_lo <= p[1] < g.lon_hi]
        assert inside == ([] if cell is None else [cell])


def test_nearest_airport_prefers_lower_ordinal_on_ties(spark):
    table = (("AAA", 10.0, 10.0), ("BBB", 10.0, 10.0), ("CCC", 11.0, 10.0))
    near = one(spark, n=geo.nearest_airport(F.lit(10.0), F.lit(10.0), table)).n
    assert (near.code, near.dist) == ("AAA", 0.0)


def test_live_box_is_closed(spark):
    row = one(spark, low=geo.in_live_box(*lits(24, -125)), high=geo.in_live_box(*lits(50, -66)),
              out=geo.in_live_box(*lits(23.999, -100)))
    assert tuple(row) == (True, True, False)


def test_missing_values_have_no_band(spark):
    from avspark.functions import flights, positions, weather

    row = spark.range(1).select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("s")).select(
        flights.delay_band(F.col("x")), flights.delay_colour(F.col("x")), flights.delay_opacity(F.col("x")),
        flights.risk_label(F.col("x")), flights.probability_colour(F.col("x")), positions.altitude_band(F.col("x")),
        positions.altitude_colour(F.col("x")), weather.conditions(F.col("x"), F.lit(5000)), weather.marker_colour(F.col("s"))).first()
    assert set(row) == {None}


def test_malformed_numbers_count_as_missing(spark):
    from avspark.sources import decode

    text = '{"time": 5, "states": [["a", "b", "c", 1, 1, "10", "20", "oops", "x", "oops", null, 1, 1, "7"], ["d", "e", "f", 1, 1, "oops", "20", 1, false, 1, 1, 1, 1, 1]]}'
    rows = decode.decode_states(spark.createDataFrame([(text,)], "response string")).collect()
    assert [(r.icao24, r.altitude_m, r.velocity_mps, r.on_ground) for r in rows] == [("a", 7.0, 0.0, False)]
