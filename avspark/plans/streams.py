"""Streaming jobs run over the event feed to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from avspark import dims
from avspark.functions.numeric import round_dp
from avspark.ml import predict
from avspark.operators import weather
from avspark.plans.ctes import haversine, rnd, sector, with_ctes
from avspark.plans.learning import _models
from avspark.plans.registry import query
from avspark.session import new_path, state_session
from avspark.sources import bindings as b
from avspark.sources import snapshots
from avspark.streaming import jobs, sinks

_BOX = "latitude BETWEEN 24 AND 50 AND longitude BETWEEN -125 AND -66"
_FIELDS = ("event_id, ts, icao24, callsign, origin_country, longitude, latitude, altitude_m, velocity_mps, "
           "heading_deg, on_ground")


def _positions(spark, sf_dir):
    return jobs.position_stream(jobs.event_stream(spark, sf_dir, "events.parquet"))


def _ntz(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def _run(spark, stream, name, mode="append"):
    path = new_path(spark, name)
    sinks.run_to_table(stream, f"{path}/table", f"{path}/checkpoint", mode)
    return f"{path}/table"


@query("x1_position_stream", with_ctes(f"SELECT {_FIELDS} FROM states WHERE {_BOX}", "states"))
def x1(spark, sf_dir):
    table = _run(spark, _positions(spark, sf_dir), "x1")
    return _ntz(sinks.read_appended(spark, table), "ts")


# On-time reports arrive first, every 50th report only after all the others.
_MARK = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 MINUTE FROM inbox WHERE event_id%50<>0)"
_LAST_MARK = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 MINUTE FROM inbox)"


@query("x2_late_rows", with_ctes(f"""
    SELECT hour_start, CAST(count(*) AS BIGINT) AS reports, hour_start + INTERVAL 1 HOUR > {_LAST_MARK} AS is_open,
      CAST((SELECT count(*) FROM inbox WHERE event_id%50=0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_MARK}) AS BIGINT)
        AS late_rows_refused
    FROM (SELECT *, date_trunc('hour', ts) AS hour_start FROM inbox)
    WHERE event_id%50 <> 0 OR hour_start + INTERVAL 1 HOUR > {_MARK} GROUP BY hour_start""",
    "states", inbox=f"SELECT * FROM states WHERE {_BOX}"))
def x2(spark, sf_dir):
    path = new_path(spark, "x2")
    events = b.table(spark, sf_dir, "events")
    late = F.col("event_id") % 50 == 0
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(f"{path}/feed")
        feed = jobs.event_stream(spark, f"{path}/feed")
        sinks.run_to_table(
            jobs.hourly_counts(jobs.position_stream(feed)), f"{path}/table", f"{path}/checkpoint", "update")
    return _ntz(sinks.read_hourly_counts(spark, f"{path}/table"), "hour_start")


@query("x3_without_repeats", with_ctes(
    f"SELECT DISTINCT icao24, ts FROM states WHERE {_BOX}", "states"))
def x3(spark, sf_dir):
    # Each poll repeats the reports of the one before it.
    polled = _positions(spark, sf_dir).withColumn("poll", F.explode(F.array(F.lit(0), F.lit(1))))
    table = _run(spark, jobs.without_repeats(polled).select("icao24", "ts"), "x3")
    return _ntz(sinks.read_appended(spark, table), "ts")


@query("x4_latest_state", with_ctes(f"""
    SELECT {_FIELDS} FROM states WHERE {_BOX}
    QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY ts DESC, event_id DESC) = 1""", "states"))
def x4(spark, sf_dir):
    table = _run(spark, jobs.latest_state(_positions(spark, sf_dir)), "x4", "update")
    return _ntz(sinks.read_updated(spark, table, ["icao24"]), "ts")


@query("x5_band_kpis", with_ctes(f"""
    SELECT date_trunc('hour', ts) AS hour_start,
      CASE WHEN altitude_m<1524 THEN 'low' WHEN altitude_m<7620 THEN 'mid' ELSE 'high' END AS band,
      CAST(count(*) AS BIGINT) AS reports, CAST(count(*) FILTER (NOT on_ground) AS BIGINT) AS airborne,
      CAST(count(*) FILTER (on_ground) AS BIGINT) AS ground
    FROM states WHERE {_BOX} GROUP BY 1, 2""", "states"))
def x5(spark, sf_dir):
    table = _run(spark, jobs.band_kpis(_positions(spark, sf_dir)), "x5", "update")
    return _ntz(sinks.read_updated(spark, table, ["hour_start", "band"]), "hour_start")


@query("x6_sliding_sector_load", with_ctes(f"""
    SELECT time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(CAST(k*15 AS INTEGER)) AS window_start,
      {sector('latitude', 'longitude')} AS sector_id, CAST(count(*) AS BIGINT) AS positions,
      count(*) >= 15 AS flow_control
    FROM states, range(4) g(k) WHERE {_BOX} AND {sector('latitude', 'longitude')} IS NOT NULL GROUP BY 1, 2""",
    "states"))
def x6(spark, sf_dir):
    table = _run(spark, jobs.sliding_sector_load(_positions(spark, sf_dir)), "x6", "update")
    return _ntz(sinks.read_updated(spark, table, ["window_start", "sector_id"]), "window_start")


# Reports that open a leg are those in the air after a report on the ground, after a gap, or first.
# The report behind the last one of a leg says how it ends.
@query("x7_flight_legs", with_ctes(f"""
    SELECT icao24, leg_start, leg_end, reports, top_altitude_m, ended_by,
      NOT epoch_ms(leg_end) < (SELECT epoch_ms(max(ts)) - 300000 FROM inbox) AS is_open
    FROM (
      SELECT icao24, min(ts) AS leg_start, CAST(count(*) AS BIGINT) AS reports, max(altitude_m) AS top_altitude_m,
        max_by(CASE WHEN next_ts < ts + INTERVAL 30 MINUTE THEN next_ts ELSE ts + INTERVAL 30 MINUTE END, (ts, event_id)) AS leg_end,
        max_by(CASE WHEN next_ts < ts + INTERVAL 30 MINUTE THEN 'ground' ELSE 'gap' END, (ts, event_id)) AS ended_by
      FROM (SELECT *, sum(opens) OVER (PARTITION BY icao24 ORDER BY ts, event_id) AS leg FROM (
        SELECT *, lead(ts) OVER (PARTITION BY icao24 ORDER BY ts, event_id) AS next_ts,
          CASE WHEN on_ground THEN 0 WHEN lag(on_ground) OVER (PARTITION BY icao24 ORDER BY ts, event_id) THEN 1
               WHEN ts < lag(ts) OVER (PARTITION BY icao24 ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
        FROM inbox))
      WHERE NOT on_ground GROUP BY icao24, leg)""",
    "states", inbox=f"SELECT * FROM states WHERE {_BOX}"))
def x7(spark, sf_dir):
    path = new_path(spark, "x7")
    legs = jobs.flight_legs(_positions(state_session(spark), sf_dir))
    sinks.run_to_table(legs, f"{path}/table", f"{path}/checkpoint", "update")
    return _ntz(sinks.read_legs(spark, f"{path}/table"), "leg_start", "leg_end")


@query("x8_airport_risk", with_ctes(f"""
    SELECT q.event_id, q.ts, icao24, code AS nearest_airport, {rnd('mi', 1)} AS nearest_mi, risk_score
    FROM (SELECT s.*, n.code, {haversine('s.latitude', 's.longitude', 'n.lat', 'n.lon')} AS mi, n.ord
          FROM states s, network n WHERE {_BOX}
          QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY mi, n.ord) = 1) q
    LEFT JOIN latest_live l ON l.airport = code""", "states", "network", "latest_live"))
def x8(spark, sf_dir):
    now = jobs.static_side(weather.latest_live(b.live_weather(spark, sf_dir), dims.airports(spark, dims.NETWORK)))
    stream = jobs.with_airport_risk(_positions(spark, sf_dir), now).select(
        "event_id", "ts", "icao24", "nearest_airport",
        round_dp(F.col("nearest_mi"), 1).alias("nearest_mi"), "risk_score")
    return _ntz(sinks.read_appended(spark, _run(spark, stream, "x8")), "ts")


def _request_stream(events):
    """Prediction requests as a stream: one per event."""
    u, e = F.col("user_id"), F.col("event_id")
    return events.select(
        e.cast("string").alias("request_id"),
        dims.pick(dims.NETWORK_CODES, u % 25).alias("origin"),
        dims.pick(dims.NETWORK_CODES, (u + 1 + e % 24) % 25).alias("destination"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scheduled_departure"),
        dims.pick(dims.AIRLINES, e % 8).alias("airline"),
        dims.pick(dims.AIRCRAFT_TYPES, e % 4).alias("aircraft_type"),
        F.lit(9).alias("dep_hour"), F.lit(0).alias("day_of_week"),
        F.lit(None).cast("double").alias("distance_mi"), F.lit(50).alias("row_limit"),
    )


@query("x8_stream_predictions")
def x8_predictions(spark, sf_dir):
    asked = _request_stream(jobs.event_stream(spark, sf_dir, "events.parquet"))
    airports = dims.airports(spark)
    now = jobs.static_side(weather.newest_records(b.live_weather(spark, sf_dir), airports))
    scored = predict.predict_delays(asked, now, airports, _models(spark, sf_dir))
    return sinks.read_appended(spark, _run(spark, scored, "x8-predictions"))


# One row a report with the age of the position before it, one row each time a position expires,
# at the end of the feed only where the watermark has passed that time.
@query("x9_freshness", with_ctes("""
    SELECT icao24, ts_ms, coalesce((ts_ms - was) / 1000.0, 0.0)::DOUBLE AS age_s,
      CASE WHEN was IS NULL OR ts_ms - was <= 60000 THEN 'FRESH' WHEN ts_ms - was <= 300000 THEN 'STALE' ELSE 'EXPIRED' END AS status
    FROM gaps
    UNION ALL SELECT icao24, was, 300.0::DOUBLE, 'EXPIRED' FROM gaps WHERE ts_ms - was > 300000
    UNION ALL SELECT icao24, max(ts_ms), 300.0::DOUBLE, 'EXPIRED' FROM gaps GROUP BY icao24
      HAVING max(ts_ms) + 300000 < (SELECT max(ts_ms) FROM gaps) - 300000""",
    "states", gaps=f"""SELECT *, lag(ts_ms) OVER (PARTITION BY icao24 ORDER BY ts_ms) AS was
      FROM (SELECT DISTINCT icao24, epoch_us(ts)//1000 AS ts_ms FROM states WHERE {_BOX})"""))
def x9(spark, sf_dir):
    table = _run(spark, jobs.freshness(_positions(spark, sf_dir)), "x9")
    return sinks.read_appended(spark, table)


@query("x10_snapshot_sink", with_ctes("""
    SELECT fetched_at, icao24, callsign, origin_country, longitude, latitude, altitude_m, velocity_mps,
      heading_deg, on_ground
    FROM (SELECT *, max(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY CAST(ts AS DATE)) AS fetched_at
          FROM inbox)
    QUALIFY dense_rank() OVER (ORDER BY fetched_at DESC) <= 10""",
    "states", inbox=f"SELECT * FROM states WHERE {_BOX}"))
def x10(spark, sf_dir):
    path = new_path(spark, "x10")
    events = b.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    # One landed file, and so one poll, a day.
    events.repartition("day").write.partitionBy("day").parquet(f"{path}/feed")
    feed = jobs.event_stream(spark, f"{path}/feed", files_per_batch=1)
    sinks.run_snapshots(jobs.position_stream(feed), f"{path}/log", f"{path}/checkpoint")
    return snapshots.from_log(snapshots.read_log(spark, f"{path}/log"))
