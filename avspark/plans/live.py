"""Live positions: decoding, snapshots, filters, display tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from avspark.operators import positions as op
from avspark.plans.ctes import rnd, with_ctes
from avspark.plans.registry import query
from avspark.session import new_path
from avspark.sources import bindings as b
from avspark.sources import decode, snapshots

_STATE = ("icao24, callsign, origin_country, longitude, latitude, altitude_m, velocity_mps, "
          "heading_deg, on_ground")
_FT = "altitude_m*3.28084"
_KNOTS = rnd("velocity_mps*1.944", 1)
# One second after the last full day of the feed.
NOW = 1_706_659_200


@query("s6_decode_states", with_ctes(
    f"SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS fetched_at, {_STATE} FROM states "
    "WHERE latitude IS NOT NULL", "states"))
def s6(spark, sf_dir):
    return decode.decode_states(b.raw_states(spark, sf_dir))


@query("s6_quarantine", with_ctes("""
    SELECT event_id, vector, accepted, reason, CASE WHEN accepted THEN icao24 END AS icao24, CASE WHEN accepted THEN latitude END AS latitude
    FROM (
      SELECT event_id, CAST(v AS INTEGER) AS vector, icao24, latitude, reason IS NULL AS accepted, reason FROM (
        SELECT *, CASE WHEN v = 1 OR latitude IS NULL THEN 'missing_position' WHEN event_id%83=1 THEN 'bad_number' END AS reason
        FROM states, range(2) t(v) WHERE event_id%89<>0)
      UNION ALL SELECT event_id, NULL, icao24, latitude, false, 'bad_response' FROM states WHERE event_id%89=0)""", "states"))
def s6_quarantine(spark, sf_dir):
    """Accepted and quarantined vectors together are all vectors; some responses are cut off, some have a word for a number."""
    e, text = F.col("event_id"), F.col("response")
    word = F.regexp_replace(text, r'("[^"]*","[^"]*","[^"]*",1,2),[-0-9.Ee]+,', '$1,"east",')
    responses = b.raw_states(spark, sf_dir).withColumn(
        "response", F.when(e % 89 == 0, F.substring(text, 1, 30)).when(e % 83 == 1, word).otherwise(text))
    path = new_path(spark, "quarantine")
    decode.write_with_quarantine(responses, path)
    good, bad = decode.read_accepted(spark, path), decode.read_quarantine(spark, path)
    return good.select("event_id", "vector", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason"), "icao24", "latitude").unionByName(
        bad.select("event_id", "vector", F.lit(False).alias("accepted"), "reason"), allowMissingColumns=True)


_FORECAST = """
    SELECT event_id, CAST(s AS INTEGER) AS step, (event_id%30+s)::DOUBLE AS temperature_c,
      CASE WHEN event_id%5=0 THEN 5.0 ELSE event_id%50+s END::DOUBLE AS wind_speed_knots,
      CASE WHEN event_id%7=0 THEN 0.0 ELSE event_id%4+s END::DOUBLE AS precipitation_mm_hr,
      CASE WHEN event_id%11=0 THEN 10000.0 ELSE event_id*13%20000+s END::DOUBLE/1000.0 AS visibility_km,
      (event_id%99+s)::DOUBLE AS cloud_cover_pct,
      CAST(CASE WHEN event_id%3=0 THEN 0 ELSE event_id%97+s END AS INTEGER) AS weather_code
    FROM (SELECT event_id, unnest(range(0, event_id%3+1)) AS s FROM events)"""


@query("s7_first_forecast_hour", f"SELECT * EXCLUDE (step) FROM ({_FORECAST}) WHERE step = 0")
def s7(spark, sf_dir):
    return decode.first_hour(b.forecasts(spark, sf_dir))


@query("s7_forecast_series", f"SELECT * FROM ({_FORECAST})")
def s7_series(spark, sf_dir):
    return decode.hourly_series(b.forecasts(spark, sf_dir)).drop("time")


def _minute(states):
    return F.unix_seconds("ts") - F.unix_seconds("ts") % 60


def _log(spark, sf_dir):
    states = op.with_coordinates(b.aircraft_states(spark, sf_dir))
    return snapshots.to_log(states, _minute(states))


_LOG = (f"SELECT CAST(floor(epoch(ts)) AS BIGINT)//60*60 AS fetched_at, {_STATE} FROM states "
        "WHERE latitude IS NOT NULL")


@query("s8_w4_snapshot_log", with_ctes("""
    SELECT * FROM log WHERE fetched_at IN (
      SELECT fetched_at FROM (SELECT DISTINCT fetched_at FROM log) ORDER BY fetched_at DESC LIMIT 10)""",
    "states", log=_LOG))
def s8(spark, sf_dir):
    path = new_path(spark, "snapshots")
    states = op.with_coordinates(b.aircraft_states(spark, sf_dir))
    # The feed comes in two parts, the newer one first; each publishes what stays of it.
    newer = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    for part in (states.where(newer), states.where(~newer)):
        snapshots.append_snapshot(part, _minute(part), path)
    return snapshots.from_log(snapshots.read_log(spark, path))


@query("s9_t5_latest_snapshot", with_ctes(f"""
    SELECT * FROM log WHERE fetched_at = (SELECT max(fetched_at) FROM log) AND {NOW}-fetched_at <= 300""",
    "states", log=_LOG))
def s9(spark, sf_dir):
    return snapshots.latest(_log(spark, sf_dir), NOW)


@query("s10_snapshot_age", with_ctes(f"""
    SELECT 'all' AS log_part, CAST({NOW}-max(fetched_at) AS DOUBLE) AS age_s FROM log
    UNION ALL SELECT 'none', 'inf'::DOUBLE""", "states", log=_LOG))
def s10(spark, sf_dir):
    log = _log(spark, sf_dir)
    newer = log.where(F.col("fetched_at") > NOW)
    return snapshots.age_seconds(log, NOW).select(F.lit("all").alias("log_part"), "age_s").unionByName(
        snapshots.age_seconds(newer, NOW).select(F.lit("none").alias("log_part"), "age_s"))


_NEWEST = "(SELECT max(fetched_at) FROM log)"


@query("s11_source_resolution", with_ctes(f"""
    SELECT s.scenario, s.source, {_STATE} FROM log, (VALUES
      ('fresh', 'cache', 60), ('aged', 'stale', 300)) s(scenario, source, max_age)
    WHERE fetched_at = {_NEWEST}
    UNION ALL SELECT 'aged_live', 'live', {_STATE} FROM log WHERE fetched_at > {_NEWEST}-3600
    UNION ALL SELECT 'lost', 'fallback', {_STATE} FROM log WHERE fetched_at > {_NEWEST}-86400""",
    "states", log=_LOG))
def s11(spark, sf_dir):
    log = _log(spark, sf_dir)
    newest = snapshots.newest_time(log)
    live = snapshots.from_log(log.where(F.col("fetched_at") > newest - 3600))
    fallback = snapshots.from_log(log.where(F.col("fetched_at") > newest - 86400))
    out = None
    for scenario, age, feed in (
        ("fresh", 60, live), ("aged", 180, None), ("aged_live", 180, live), ("lost", 301, None),
    ):
        part = snapshots.resolve(log, newest + age, feed, fallback, newest).withColumn("scenario", F.lit(scenario))
        out = part if out is None else out.unionByName(part)
    return out


@query("p8_live_box", with_ctes(
    f"SELECT event_id, {_STATE} FROM states WHERE latitude BETWEEN 24 AND 50 AND longitude BETWEEN -125 AND -66",
    "states"))
def p8(spark, sf_dir):
    return op.in_live_box(b.aircraft_states(spark, sf_dir)).drop("ts")


@query("p9_with_coordinates", with_ctes(
    f"SELECT event_id, {_STATE} FROM states WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "states"))
def p9(spark, sf_dir):
    return op.with_coordinates(b.aircraft_states(spark, sf_dir)).drop("ts")


_TABLE = f"""
    SELECT icao24, coalesce(nullif(callsign,''),'—') AS callsign, origin_country AS country,
      {rnd('latitude', 3)} AS lat, {rnd('longitude', 3)} AS lon,
      CAST(trunc({_FT}) AS INTEGER) AS altitude_ft, {_KNOTS} AS speed_kts,
      {rnd('heading_deg', 0)} AS heading_deg, CASE WHEN on_ground THEN 'Yes' ELSE 'No' END AS on_ground
    FROM states"""


@query("p15_live_table", with_ctes(_TABLE, "states"))
def p15(spark, sf_dir):
    return op.live_table(b.aircraft_states(spark, sf_dir))


@query("p10_filtered_live_table", with_ctes(
    f"SELECT * FROM ({_TABLE}) WHERE altitude_ft >= 10000 AND regexp_matches(callsign, 'PUR')", "states"))
def p10(spark, sf_dir):
    return op.filter_live_table(op.live_table(b.aircraft_states(spark, sf_dir)), 10_000, "pur")


_COLOUR = ("CASE WHEN altitude_m<1524 THEN '30,144,255,200' WHEN altitude_m<7620 THEN '255,215,0,200' "
           "ELSE '255,69,0,220' END")


@query("p16_h16_map_points", with_ctes(f"""
    SELECT longitude AS lon, latitude AS lat, altitude_m, {rnd(_FT, 0)} AS altitude_ft,
      coalesce(nullif(callsign,''), icao24) AS callsign, heading_deg AS heading,
      {_KNOTS} AS velocity_knots, {_COLOUR} AS color FROM states WHERE latitude IS NOT NULL""", "states"))
def p16(spark, sf_dir):
    points = op.map_points(b.aircraft_states(spark, sf_dir))
    return points.withColumn("color", F.concat_ws(",", F.col("color").cast("array<string>")))


@query("h17_h23_units_and_altitude", with_ctes(f"""
    SELECT event_id, geo_altitude, baro_altitude, altitude_m, {rnd(_FT, 3)} AS altitude_ft,
      {_KNOTS} AS speed_kts, altitude_m/1000.0::DOUBLE AS altitude_km FROM states""", "states"))
def h17(spark, sf_dir):
    from avspark.functions import positions
    from avspark.functions.numeric import round_dp

    states = b.positions_from_events(b.table(spark, sf_dir, "events"))
    best = positions.best_altitude(F.col("geo_altitude"), F.col("baro_altitude"))
    return states.select(
        "event_id", "geo_altitude", "baro_altitude", best.alias("altitude_m"),
        round_dp(positions.feet(best), 3).alias("altitude_ft"),
        positions.knots(F.col("velocity_mps")).alias("speed_kts"),
        positions.kilometres(best).alias("altitude_km"),
    )


@query("a24_altitude_bands", with_ctes("""
    SELECT CASE WHEN altitude_m<1524 THEN 'low' WHEN altitude_m<7620 THEN 'mid' ELSE 'high' END AS band,
      CAST(count(*) AS BIGINT) AS aircraft FROM states GROUP BY 1""", "states"))
def a24(spark, sf_dir):
    return op.altitude_band_counts(b.aircraft_states(spark, sf_dir))


@query("a25_live_kpis", with_ctes(f"""
    SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (NOT on_ground) AS BIGINT) AS airborne,
      CAST(count(*) FILTER (on_ground) AS BIGINT) AS ground,
      {rnd(f'sum(CAST(trunc({_FT}) AS BIGINT)) FILTER (NOT on_ground)/(count(*) FILTER (NOT on_ground))::DOUBLE', 1)}
        AS avg_altitude_ft FROM states""", "states"))
def a25(spark, sf_dir):
    return op.live_kpis(b.aircraft_states(spark, sf_dir))


@query("a26_altitude_histogram", with_ctes(f"""
    SELECT bin, CAST(count(*) AS BIGINT) AS aircraft, {rnd('any_value(lo+bin*(hi-lo)/40.0::DOUBLE)', 2)} AS from_ft
    FROM (SELECT CAST(least(((ft-lo)*40)//greatest(hi-lo,1), 39) AS INTEGER) AS bin, lo, hi FROM (
      SELECT ft, min(ft) OVER () AS lo, max(ft) OVER () AS hi FROM (
        SELECT CAST(trunc({_FT}) AS BIGINT) AS ft FROM states WHERE NOT on_ground))) GROUP BY bin""", "states"))
def a26(spark, sf_dir):
    return op.altitude_histogram(b.aircraft_states(spark, sf_dir))


@query("g8_state_json_round_trip", with_ctes(_LOG, "states"))
def g8(spark, sf_dir):
    return snapshots.from_log(_log(spark, sf_dir))
