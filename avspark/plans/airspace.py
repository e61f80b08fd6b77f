"""Weather, routes and sectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions.numeric import round_dp
from avspark.ml.features import DEFAULT_WEATHER_SCORE
from avspark.operators import lookups, routes, sectors, weather
from avspark.operators.positions import with_coordinates
from avspark.plans.ctes import fixed, great_circle, haversine, risk, rnd, sector, with_ctes
from avspark.plans.registry import query
from avspark.sources import bindings as b


def _flights(spark, sf_dir, *columns):
    return b.ops_flights(spark, sf_dir, *columns)


def _net(spark):
    return dims.airports(spark, dims.NETWORK)


# --- weather ---------------------------------------------------------------

@query("h9_h10_weather_scoring", with_ctes("""
    SELECT airport, ts, hour, wind_speed_kts, wind_dir_deg, visibility_sm, ceiling_ft, conditions,
      weather_impact_score FROM obs""", "obs"))
def h9(spark, sf_dir):
    return b.weather_obs(spark, sf_dir)


@query("h11_live_risk", with_ctes(f"SELECT *, {risk()} AS risk_score FROM live", "live"))
def h11(spark, sf_dir):
    return weather.with_risk(b.live_weather(spark, sf_dir))


def _asof(role: str) -> str:
    return f"""
    SELECT k.*, weather_impact_score AS {role}_impact, conditions AS {role}_conditions
    FROM (SELECT f.*, greatest(scheduled_departure, lo) AS t FROM SOURCE f
          LEFT JOIN bounds ON airport = {role}) k
    ASOF LEFT JOIN obs o ON o.airport = k.{role} AND k.t >= o.ts"""


@query("j3_asof_weather", with_ctes("""
    SELECT flight_id, origin, destination, scheduled_departure, origin_impact, origin_conditions,
      destination_impact, destination_conditions FROM both_ends""", "ops", "obs", "bounds",
    one_end=_asof("origin").replace("SOURCE", "ops"),
    both_ends=_asof("destination").replace("SOURCE", "(SELECT * EXCLUDE (t) FROM one_end)")))
def j3(spark, sf_dir):
    flights = _flights(spark, sf_dir, "flight_id", "origin", "destination", "scheduled_departure")
    return weather.flight_weather(flights, b.weather_obs(spark, sf_dir), _net(spark))


@query("a17_j8_hourly_impact", with_ctes(f"""
    SELECT code AS airport, CAST(h AS INTEGER) AS hour, coalesce(m, 0.0) AS mean_impact
    FROM network, range(24) t(h) LEFT JOIN (
      SELECT airport, hour, {rnd('sum(CAST(round(weather_impact_score*1000) AS BIGINT))/(1000.0::DOUBLE*count(*))', 4)} AS m
      FROM obs GROUP BY airport, hour) o ON o.airport = code AND o.hour = h""", "obs", "network"))
def a17(spark, sf_dir):
    return weather.hourly_impact(b.weather_obs(spark, sf_dir), _net(spark))


_AT_TIME = """
    SELECT code AS airport, city, reference_time, conditions, visibility_sm, ceiling_ft, wind_speed_kts, weather_impact_score
    FROM (SELECT n.*, TIMESTAMP '{at}' AS reference_time, greatest(TIMESTAMP '{at}', lo) AS t
          FROM network n JOIN bounds ON airport = code) k
    ASOF JOIN obs o ON o.airport = k.code AND k.t >= o.ts"""


@query("a30_conditions_at", with_ctes(_AT_TIME.format(at="2024-01-15 09:00:00"), "obs", "bounds", "network"))
def a30(spark, sf_dir):
    return weather.conditions_at(b.weather_obs(spark, sf_dir), _net(spark), "2024-01-15 09:00:00")


@query("h20_weather_halos", with_ctes(f"""
    SELECT airport, ts, lat, lon, conditions,
      CASE conditions WHEN 'MVMC' THEN 'orange' ELSE 'red' END AS marker,
      {rnd('50000+weather_impact_score*150000', 1)} AS radius_m
    FROM obs JOIN network ON code = airport WHERE conditions <> 'VMC'""", "obs", "network"))
def h20(spark, sf_dir):
    return weather.halos(b.weather_obs(spark, sf_dir), _net(spark))


_FIELDS = ("temperature_c", "wind_speed_knots", "precipitation_mm_hr", "visibility_km", "cloud_cover_pct",
           "weather_code")


@query("j6_route_weather", with_ctes(f"""
    SELECT r.origin, r.destination,
      {', '.join(f'o.{c} AS origin_{c}, d.{c} AS destination_{c}' for c in _FIELDS)},
      coalesce(o.risk_score, {DEFAULT_WEATHER_SCORE}::DOUBLE) AS origin_risk,
      coalesce(d.risk_score, {DEFAULT_WEATHER_SCORE}::DOUBLE) AS destination_risk,
      greatest(coalesce(o.risk_score, {DEFAULT_WEATHER_SCORE}::DOUBLE), coalesce(d.risk_score, {DEFAULT_WEATHER_SCORE}::DOUBLE))
        AS max_risk_score
    FROM (SELECT DISTINCT origin, destination FROM perf) r
    LEFT JOIN latest_live o ON o.airport = r.origin LEFT JOIN latest_live d ON d.airport = r.destination""",
    "perf", "latest_live"))
def j6(spark, sf_dir):
    routes_ = _flights(spark, sf_dir, "origin", "destination").distinct()
    both = weather.route_weather(routes_, b.live_weather(spark, sf_dir), _net(spark), DEFAULT_WEATHER_SCORE)
    return both.select(
        "origin", "destination",
        *[F.col(f"{role}_weather.{c}").alias(f"{role}_{c}")
          for c in _FIELDS for role in ("origin", "destination")],
        "origin_risk", "destination_risk", "max_risk_score",
    )


_BLEND = rnd("0.7::DOUBLE*p+0.3::DOUBLE*r", 3)


@query("h14_h15_h21_blended_prediction", with_ctes(f"""
    SELECT flight_id, delay_probability, {rnd('delay_probability*90.0', 1)} AS expected_delay_minutes,
      r AS weather_risk_score,
      CASE WHEN delay_probability>0.6 THEN 'HIGH' WHEN delay_probability>0.35 THEN 'MODERATE' ELSE 'LOW' END AS risk_label,
      CASE WHEN p IS NULL THEN 'low' ELSE 'high' END AS confidence,
      'Origin: wind '||{fixed('wind_speed_knots', 0)}||' kn, vis '||{fixed('visibility_km', 1)}||' km, precip '
        ||{fixed('precipitation_mm_hr', 1)}||' mm/h. Route max risk: '||{fixed('r', 2)}||'.' AS weather_summary,
      CASE WHEN p IS NOT NULL THEN 'ML model probability '||{fixed('p', 2)}
        ||' (weight 0.70) combined with weather risk '||{fixed('r', 2)}||' (weight 0.30) → '
        ||{fixed('delay_probability', 2)}||'.'
      ELSE 'ML model unavailable — delay probability driven entirely by live weather risk score '
        ||{fixed('r', 2)}||'.' END AS explanation
    FROM (SELECT *, CASE WHEN p IS NOT NULL THEN {_BLEND} ELSE {rnd('r', 3)} END AS delay_probability FROM (
      SELECT f.flight_id, CASE WHEN l_partkey%37<>0 THEN (l_partkey%100)/100.0::DOUBLE END AS p,
        greatest(o.risk_score, d.risk_score) AS r, o.wind_speed_knots, o.visibility_km, o.precipitation_mm_hr
      FROM perf f JOIN latest_live o ON o.airport=f.origin JOIN latest_live d ON d.airport=f.destination))""",
    "perf", "latest_live"))
def h14(spark, sf_dir):
    flights = _flights(spark, sf_dir, "flight_id", "origin", "destination")
    model = b.predictions(spark, sf_dir).where("version = 0").select(
        "flight_id", F.col("delay_probability").alias("p"))
    scored = weather.route_weather(flights, b.live_weather(spark, sf_dir), _net(spark)).join(
        model, "flight_id", "left")
    p, r = F.col("p"), F.col("max_risk_score")
    blended = scored.withColumn("delay_probability", ff.blended_probability(p, r))
    prob, w = F.col("delay_probability"), F.col("origin_weather")
    return blended.select(
        "flight_id", "delay_probability", ff.expected_delay(prob).alias("expected_delay_minutes"),
        r.alias("weather_risk_score"), ff.risk_label(prob).alias("risk_label"),
        ff.confidence(p).alias("confidence"),
        ff.weather_summary(w["wind_speed_knots"], w["visibility_km"], w["precipitation_mm_hr"], r)
        .alias("weather_summary"),
        ff.explanation(p, r, prob).alias("explanation"),
    )


@query("h19_h22_route_risk_map", with_ctes("""
    SELECT flight_id, CASE WHEN l_partkey%3=0 THEN origin||'→'||destination ELSE flight_number END AS label,
      CASE WHEN l_partkey%5=0 THEN 'N/A' ELSE airline END AS airline,
      CASE WHEN p<0.30 THEN '#2ea043' WHEN p<0.60 THEN '#d29922' ELSE '#f85149' END AS colour,
      2.0+p*4.0 AS weight, 0.4+p*0.5 AS opacity
    FROM (SELECT *, (l_partkey%100)/100.0::DOUBLE AS p FROM ops)""", "ops"))
def h19(spark, sf_dir):
    flights = _flights(spark, sf_dir, "flight_id", "flight_number", "airline", "origin", "destination")
    part = F.split("flight_id", "-")[2].cast("bigint")
    rows = flights.select(
        "flight_id", "origin", "destination", (part % 100 / 100).alias("p"),
        F.when(part % 3 != 0, F.col("flight_number")).otherwise("").alias("flight_number"),
        F.when(part % 5 != 0, F.col("airline")).otherwise("").alias("airline"),
    )
    known = lookups.known_airports_only(rows, dims.airports(spark))
    p = F.col("p")
    return known.select(
        "flight_id",
        ff.or_default(F.col("flight_number"), ff.route_label(F.col("origin"), F.col("destination"))).alias("label"),
        ff.or_default(F.col("airline"), "N/A").alias("airline"),
        ff.probability_colour(p).alias("colour"), ff.probability_weight(p).alias("weight"),
        ff.probability_opacity(p).alias("opacity"),
    )


@query("p19_missing_input_defaults", with_ctes(f"""
    SELECT request_id, coalesce(po.impact, 0.3) AS origin_score, coalesce(pd.impact, 0.3) AS destination_score,
      coalesce(r.distance_mi, {rnd(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1)}, 1500.0::DOUBLE) AS distance_mi
    FROM (SELECT flight_id AS request_id, CASE WHEN l_partkey%11=3 THEN 'ZZZ' ELSE origin END AS origin,
            CASE WHEN l_partkey%13=1 THEN 'ZZZ' ELSE destination END AS destination,
            CASE WHEN l_partkey%31=1 THEN NULL ELSE distance_mi END AS distance_mi, dep_hour FROM perf) r
    LEFT JOIN pinned po ON po.airport=r.origin AND po.hour=r.dep_hour
    LEFT JOIN pinned pd ON pd.airport=r.destination AND pd.hour=r.dep_hour
    LEFT JOIN airports o ON o.code=r.origin LEFT JOIN airports d ON d.code=r.destination""",
    "perf", "obs", "bounds", "network", "airports", pinned="""
    SELECT k.code AS airport, k.hour, o.weather_impact_score AS impact
    FROM (SELECT code, CAST(h AS INTEGER) AS hour,
            greatest(TIMESTAMP '2024-01-15'+to_hours(h), lo) AS t
          FROM network JOIN bounds ON airport=code, range(24) g(h)) k
    ASOF JOIN obs o ON o.airport=k.code AND k.t>=o.ts"""))
def p19(spark, sf_dir):
    from avspark.ml.features import fill_missing_inputs

    flights = _flights(spark, sf_dir, "flight_id", "origin", "destination", "distance_mi", "dep_hour")
    part = F.split("flight_id", "-")[2].cast("bigint")
    asked = flights.select(
        F.col("flight_id").alias("request_id"),
        F.when(part % 11 == 3, "ZZZ").otherwise(F.col("origin")).alias("origin"),
        F.when(part % 13 == 1, "ZZZ").otherwise(F.col("destination")).alias("destination"),
        F.when(part % 31 != 1, F.col("distance_mi")).alias("distance_mi"), "dep_hour",
    )
    filled = fill_missing_inputs(asked, b.weather_obs(spark, sf_dir), _net(spark), dims.airports(spark))
    return filled.select("request_id", "origin_score", "destination_score", "distance_mi")


# --- routes ----------------------------------------------------------------

_WP20 = great_circle("used", 20)
_USED = "SELECT DISTINCT p.* FROM pairs p JOIN perf USING (origin, destination)"
_LATLON = f"{rnd('lat', 4)} AS lat, {rnd('lon', 4)} AS lon"


@query("g1_g2_great_circle", with_ctes(
    f"SELECT origin, destination, i, {_LATLON} FROM wp", "perf", "pairs", used=_USED, wp=_WP20))
def g1(spark, sf_dir):
    used = routes.distinct_routes(_flights(spark, sf_dir, "origin", "destination"), _net(spark))
    return routes.route_points(used).select(
        "origin", "destination", "i", round_dp(F.col("lat"), 4).alias("lat"),
        round_dp(F.col("lon"), 4).alias("lon"))


_PATH = f"""
    SELECT *, sum(segment_mi) OVER (PARTITION BY origin, destination ORDER BY i) AS path_mi FROM (
      SELECT *, coalesce({haversine('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')}, 0.0) AS segment_mi
      FROM wp WINDOW w AS (PARTITION BY origin, destination ORDER BY i))"""


@query("w2_w3_path_distance", with_ctes(
    f"SELECT origin, destination, i, {rnd('segment_mi', 3)} AS segment_mi, {rnd('path_mi', 3)} AS path_mi FROM ({_PATH})",
    "perf", "pairs", used=_USED, wp=_WP20))
def w2(spark, sf_dir):
    used = routes.distinct_routes(_flights(spark, sf_dir, "origin", "destination"), _net(spark))
    path = routes.with_path_distance(routes.route_points(used))
    return path.select("origin", "destination", "i", round_dp(F.col("segment_mi"), 3).alias("segment_mi"),
                       round_dp(F.col("path_mi"), 3).alias("path_mi"))


_NEAR = f"""
    SELECT wp.*, n.code AS nearest_airport, {haversine('wp.lat', 'wp.lon', 'n.lat', 'n.lon')} AS nearest_mi
    FROM wp, network n
    QUALIFY row_number() OVER (PARTITION BY origin, destination, i ORDER BY nearest_mi, n.ord) = 1"""


@query("j4_nearest_airport", with_ctes(
    f"SELECT origin, destination, i, nearest_airport, {rnd('nearest_mi', 1)} AS nearest_mi, "
    "nearest_mi < 300 AS in_reach FROM near", "perf", "pairs", used=_USED, wp=_WP20, near=_NEAR))
def j4(spark, sf_dir):
    used = routes.distinct_routes(_flights(spark, sf_dir, "origin", "destination"), _net(spark))
    near = routes.with_nearest_airport(routes.route_points(used))
    return near.select(
        "origin", "destination", "i", "nearest_airport",
        round_dp(F.col("nearest_mi"), 1).alias("nearest_mi"), (F.col("nearest_mi") < 300).alias("in_reach"))


@query("g3_annotated_waypoints", with_ctes(f"""
    SELECT p.origin, p.destination, p.i, {rnd('p.lat', 4)} AS lat, {rnd('p.lon', 4)} AS lon,
      {rnd('p.path_mi', 1)} AS distance_from_origin_mi,
      CASE WHEN nearest_mi<300 THEN coalesce(weather_impact_score, 0.0) ELSE 0.0 END AS weather_impact_score,
      nearest_airport, {rnd('nearest_mi', 1)} AS dist_to_nearest_apt_mi
    FROM ({_PATH}) p JOIN near n USING (origin, destination, i)
    LEFT JOIN ({_AT_TIME.format(at='2024-01-01 07:00:00')}) w ON w.airport = nearest_airport""",
    "perf", "pairs", "obs", "bounds", "network", used=_USED, wp=_WP20, near=_NEAR))
def g3(spark, sf_dir):
    return routes.annotated_waypoints(
        _flights(spark, sf_dir, "origin", "destination"), b.weather_obs(spark, sf_dir), _net(spark))


@query("g6_nested_paths", with_ctes(f"""
    SELECT origin, destination, CAST(count(*) AS INTEGER) AS points,
      string_agg(i||':'||CAST(CAST({rnd('lat', 4)} AS DECIMAL(9,4)) AS VARCHAR)||','||CAST(CAST({rnd('lon', 4)} AS DECIMAL(9,4)) AS VARCHAR),
                 ' ' ORDER BY i) AS path FROM wp GROUP BY origin, destination""",
    "perf", "pairs", used=_USED, wp=_WP20))
def g6(spark, sf_dir):
    used = routes.distinct_routes(_flights(spark, sf_dir, "origin", "destination"), _net(spark))
    text = F.transform("path", lambda p: F.concat(
        p["i"].cast("string"), F.lit(":"), p["lat"].cast("decimal(9,4)").cast("string"), F.lit(","),
        p["lon"].cast("decimal(9,4)").cast("string")))
    return routes.nested_paths(used).select(
        "origin", "destination", F.size("path").alias("points"), F.concat_ws(" ", text).alias("path"))


_MILLI = "CAST(round(coalesce(impact,0)*1000) AS BIGINT)"
_MEAN = f"sum({_MILLI})/20000.0::DOUBLE"
_HIT = f"count(*) FILTER ({_MILLI}>400)"
_RISK = f"""
    {rnd(f'least(1.0,greatest(0.0,0.5*(max({_MILLI})/1000.0::DOUBLE)+0.3*({_MEAN})+0.2*(({_HIT})/20.0::DOUBLE)))', 3)} AS risk_score,
    max({_MILLI})/1000.0::DOUBLE AS max_weather_impact, {rnd(_MEAN, 3)} AS mean_weather_impact,
    CAST({_HIT} AS BIGINT) AS weather_impacted_waypoints"""
# Every route's 20 points at every time asked for, one by one.
_SCORED = f"""
    SELECT origin, destination, ts, {_RISK} FROM (
      SELECT k.*, CASE WHEN k.nearest_mi<300 THEN o.weather_impact_score ELSE 0 END AS impact
      FROM (SELECT n.origin, n.destination, n.i, n.nearest_airport, n.nearest_mi, a.ts, greatest(a.ts, lo) AS t
            FROM asked a JOIN near n USING (origin, destination)
            LEFT JOIN bounds ON bounds.airport = nearest_airport) k
      ASOF LEFT JOIN obs o ON o.airport = k.nearest_airport AND k.t >= o.ts)
    GROUP BY origin, destination, ts"""


@query("a22_route_risk", with_ctes(f"""
    SELECT s.origin, s.destination, {rnd(haversine('o_lat', 'o_lon', 'd_lat', 'd_lon'), 1)} AS total_distance_mi,
      risk_score, max_weather_impact, mean_weather_impact, weather_impacted_waypoints
    FROM ({_SCORED}) s JOIN pairs USING (origin, destination)""",
    "perf", "pairs", "obs", "bounds", "network", used=_USED, wp=_WP20, near=_NEAR,
    asked="SELECT DISTINCT origin, destination, TIMESTAMP '2024-01-15 09:00:00' AS ts FROM perf"))
def a22(spark, sf_dir):
    return routes.route_risk(
        _flights(spark, sf_dir, "origin", "destination"), b.weather_obs(spark, sf_dir), _net(spark))


@query("a23_flight_route_risk", with_ctes(f"""
    SELECT flight_id, origin, destination, risk_score AS route_risk_score, max_weather_impact,
      mean_weather_impact, weather_impacted_waypoints
    FROM (SELECT *, date_trunc('hour', scheduled_departure) AS ts FROM ops)
    JOIN ({_SCORED}) USING (origin, destination, ts)""",
    "ops", "pairs", "obs", "bounds", "network", used=_USED, wp=_WP20, near=_NEAR,
    asked="SELECT DISTINCT origin, destination, date_trunc('hour', scheduled_departure) AS ts FROM ops"))
def a23(spark, sf_dir):
    flights = _flights(spark, sf_dir, "flight_id", "origin", "destination", "scheduled_departure")
    return routes.flight_risk(flights, b.weather_obs(spark, sf_dir), _net(spark))


# --- sectors ---------------------------------------------------------------

_GRID = """
    SELECT CAST(s AS INTEGER) AS sector_id, CAST(s//5 AS INTEGER) AS row, CAST(s%5 AS INTEGER) AS col,
      25.0::DOUBLE+s//5*6.25 AS lat_lo, 25.0::DOUBLE+(s//5+1)*6.25 AS lat_hi,
      -125.0::DOUBLE+s%5*12.0 AS lon_lo, -125.0::DOUBLE+(s%5+1)*12.0 AS lon_hi,
      printf('S%02d(R%dC%d)', s, s//5, s%5) AS sector FROM range(20) t(s)"""
# A true range join against the cell bounds, independent of the arithmetic cell id.
_IN_CELL = "lat_lo <= {lat} AND {lat} < lat_hi AND lon_lo <= {lon} AND {lon} < lon_hi"


@query("j5_point_in_sector", with_ctes(f"""
    SELECT event_id, latitude, longitude, sector_id FROM states
    LEFT JOIN grid ON {_IN_CELL.format(lat='latitude', lon='longitude')}""", "states", grid=_GRID))
def j5(spark, sf_dir):
    points = b.aircraft_states(spark, sf_dir).select("event_id", "latitude", "longitude")
    return sectors.in_sectors(points)


@query("g7_h24_sector_grid", with_ctes(f"""
    SELECT grid.*, CAST(count(event_id) AS BIGINT) AS positions FROM grid
    LEFT JOIN states ON {_IN_CELL.format(lat='latitude', lon='longitude')} GROUP BY ALL""",
    "states", grid=_GRID))
def g7(spark, sf_dir):
    states = with_coordinates(b.aircraft_states(spark, sf_dir)).select("latitude", "longitude")
    return sectors.positions_per_sector(states, spark)


_LEGS = """
    SELECT origin, destination, dep_hour, CAST(trunc(distance_mi/520*60+40) AS INTEGER) AS duration_min,
      CAST(count(*) AS BIGINT) AS flights, any_value(o_lat) AS o_lat, any_value(o_lon) AS o_lon,
      any_value(d_lat) AS d_lat, any_value(d_lon) AS d_lon
    FROM (SELECT * EXCLUDE (distance_mi) FROM perf) JOIN pairs USING (origin, destination) GROUP BY ALL"""
_LEG_HOUR = "CAST((dep_hour + CAST(floor(frac*duration_min/60) AS INTEGER))%24 AS INTEGER)"


@query("g4_w5_leg_positions", with_ctes(
    f"SELECT origin, destination, duration_min, dep_hour, flights, i, {_LATLON}, {_LEG_HOUR} AS hour FROM wp",
    "perf", "pairs", legs=_LEGS, wp=great_circle("legs", 30)))
def g4(spark, sf_dir):
    legs = sectors.flights_per_leg(_flights(spark, sf_dir, "origin", "destination", "dep_hour", "distance_mi"))
    points = sectors.leg_positions(legs)
    return points.select("origin", "destination", "duration_min", "dep_hour", "flights", "i",
                         round_dp(F.col("lat"), 4).alias("lat"), round_dp(F.col("lon"), 4).alias("lon"), "hour")


# Naive form: every flight's 30 positions, counted one by one, with distinct flight ids.
_LOAD_CTES = dict(
    legs="""SELECT flight_id, dep_hour, CAST(trunc(p.distance_mi/520*60+40) AS INTEGER) AS duration_min,
              pairs.o_lat, pairs.o_lon, pairs.d_lat, pairs.d_lon
            FROM perf p JOIN pairs USING (origin, destination)""",
    wp=great_circle("legs", 30),
    grid=_GRID,
    load=f"""SELECT s AS sector_id, h AS hour, count(*) AS positions, count(DISTINCT flight_id) AS fl
             FROM (SELECT flight_id, {_LEG_HOUR} AS h, {sector('lat', 'lon')} AS s FROM wp)
             WHERE s IS NOT NULL GROUP BY 1, 2""",
    dense="""SELECT grid.sector_id, sector, CAST(h AS INTEGER) AS hour,
               CAST(coalesce(positions, 0) AS BIGINT) AS positions,
               CAST(coalesce(fl, 0) AS BIGINT) AS distinct_flights
             FROM grid, range(24) t(h) LEFT JOIN load l ON l.sector_id = grid.sector_id AND l.hour = h""",
)


def _load(spark, sf_dir):
    flights = _flights(spark, sf_dir, "origin", "destination", "dep_hour", "distance_mi")
    return sectors.sector_load(flights)


@query("a18_sector_load", with_ctes("SELECT * FROM dense", "perf", "pairs", **_LOAD_CTES))
def a18(spark, sf_dir):
    return _load(spark, sf_dir)


@query("a19_overloaded_sectors", with_ctes("""
    SELECT sector, hour, positions AS aircraft_count, 'FLOW CONTROL' AS alert FROM dense WHERE positions >= 15""",
    "perf", "pairs", **_LOAD_CTES))
def a19(spark, sf_dir):
    return sectors.overloaded(_load(spark, sf_dir))


@query("a20_peak_sector", with_ctes("""
    SELECT sector AS peak_sector, hour AS peak_hour, positions AS peak_positions,
      (SELECT CAST(count(*) AS BIGINT) FROM dense WHERE positions >= 15) AS overloaded_count
    FROM dense ORDER BY positions DESC, sector_id, hour LIMIT 1""", "perf", "pairs", **_LOAD_CTES))
def a20(spark, sf_dir):
    return sectors.peak(_load(spark, sf_dir))


@query("a21_hourly_totals", with_ctes(
    "SELECT hour, CAST(sum(positions) AS BIGINT) AS positions FROM dense GROUP BY hour",
    "perf", "pairs", **_LOAD_CTES))
def a21(spark, sf_dir):
    return sectors.hourly_totals(_load(spark, sf_dir))


# The same for the flights of each day, which is what the overload rule is about.
_DAY_CTES = dict(
    legs="""SELECT flight_id, CAST(scheduled_departure AS DATE) AS day, dep_hour, CAST(trunc(p.distance_mi/520*60+40) AS INTEGER) AS duration_min,
              pairs.o_lat, pairs.o_lon, pairs.d_lat, pairs.d_lon
            FROM ops p JOIN pairs USING (origin, destination)""",
    wp=great_circle("legs", 30),
    grid=_GRID,
    load=f"""SELECT day, s AS sector_id, h AS hour, count(*) AS positions, count(DISTINCT flight_id) AS fl
             FROM (SELECT flight_id, day, {_LEG_HOUR} AS h, {sector('lat', 'lon')} AS s FROM wp)
             WHERE s IS NOT NULL GROUP BY ALL""",
    dense="""SELECT d.day, grid.sector_id, sector, CAST(h AS INTEGER) AS hour,
               CAST(coalesce(positions, 0) AS BIGINT) AS positions,
               CAST(coalesce(fl, 0) AS BIGINT) AS distinct_flights
             FROM (SELECT DISTINCT day FROM legs) d, grid, range(24) t(h)
             LEFT JOIN load l ON l.day = d.day AND l.sector_id = grid.sector_id AND l.hour = h""",
)


def _load_by_day(spark, sf_dir):
    return sectors.sector_load_by_day(
        b.ops_flights(spark, sf_dir, "origin", "destination", "dep_hour", "distance_mi", "scheduled_departure"))


@query("a18_sector_load_by_day", with_ctes("SELECT * FROM dense", "ops", "pairs", **_DAY_CTES))
def a18_by_day(spark, sf_dir):
    return _load_by_day(spark, sf_dir)


@query("a19_overloaded_by_day", with_ctes("""
    SELECT day, sector, hour, positions AS aircraft_count, 'FLOW CONTROL' AS alert FROM dense WHERE positions >= 15""",
    "ops", "pairs", **_DAY_CTES))
def a19_by_day(spark, sf_dir):
    return sectors.overloaded(_load_by_day(spark, sf_dir), by=("day",))


@query("a20_peak_by_day", with_ctes("""
    SELECT day, sector AS peak_sector, hour AS peak_hour, positions AS peak_positions, overloaded_count
    FROM (SELECT *, CAST(count(*) FILTER (WHERE positions >= 15) OVER (PARTITION BY day) AS BIGINT) AS overloaded_count FROM dense)
    QUALIFY row_number() OVER (PARTITION BY day ORDER BY positions DESC, sector_id, hour) = 1""", "ops", "pairs", **_DAY_CTES))
def a20_by_day(spark, sf_dir):
    return sectors.peak(_load_by_day(spark, sf_dir), by=("day",))


@query("a21_hourly_totals_by_day", with_ctes(
    "SELECT day, hour, CAST(sum(positions) AS BIGINT) AS positions FROM dense GROUP BY day, hour", "ops", "pairs", **_DAY_CTES))
def a21_by_day(spark, sf_dir):
    return sectors.hourly_totals(_load_by_day(spark, sf_dir), by=("day",))


@query("t4_peak_sector_hours", with_ctes(
    "SELECT sector, hour, positions AS count FROM dense ORDER BY positions DESC, hour, sector LIMIT 5",
    "perf", "pairs", **_LOAD_CTES))
def t4(spark, sf_dir):
    return sectors.peak_sector_hours(sectors.load_matrix(_load(spark, sf_dir)))


@query("a32_load_maps", with_ctes(
    "SELECT sector, hour, positions FROM dense", "perf", "pairs", **_LOAD_CTES))
def a32(spark, sf_dir):
    maps = sectors.load_maps(_load(spark, sf_dir))
    return maps.select(F.explode("sector_loads").alias("sector", "hours")).select(
        "sector", F.explode("hours").alias("hour", "positions"))
