"""Flight tables: storage, filters, lookups, validation, derivation (S1-S5, S15, P*, J1-J2, J7, H*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions.numeric import round_dp
from avspark.operators import lookups as op
from avspark.operators import quality
from avspark.plans.ctes import haversine, rnd, with_ctes
from avspark.plans.registry import query
from avspark.session import new_path
from avspark.sources import bindings as b
from avspark.sources import files


@query("s1_s2_parquet_round_trip", with_ctes(f"""
    SELECT CAST(year AS SMALLINT) AS year, CAST(month AS TINYINT) AS month,
      CAST(day_of_month AS TINYINT) AS day_of_month, CAST(day_of_week AS TINYINT) AS day_of_week,
      CAST(dep_hour AS TINYINT) AS dep_hour, carrier, origin, destination, distance_mi,
      delay_minutes, CAST(is_delayed AS TINYINT) AS is_delayed, delay_cause FROM perf""", "perf"))
def s1_s2(spark, sf_dir):
    path = new_path(spark, "perf-flights")
    files.write_perf_flights(b.perf_flights(spark, sf_dir), path)
    files.perf_flights_view(spark, path, "flights")
    stored = spark.sql("SELECT * FROM flights")
    for c in ("distance_mi", "delay_minutes"):
        stored = stored.withColumn(c, round_dp(F.col(c), 1))
    return stored


_OPS = """SELECT flight_id, airline, flight_number, aircraft_type, origin, destination, distance_mi,
    scheduled_departure, scheduled_arrival, actual_departure, actual_arrival, delay_minutes,
    delay_cause, is_delayed, dep_hour, day_of_week, month FROM ops"""


@query("s3_s4_csv_round_trip", with_ctes(_OPS, "ops"))
def s3_s4(spark, sf_dir):
    path = new_path(spark, "ops-flights-csv")
    files.write_flights_csv(b.ops_flights(spark, sf_dir), path)
    return files.read_flights_csv(spark, path)


@query("s5_j9_load_missing", with_ctes(
    "SELECT flight_id, origin, destination, delay_minutes, is_delayed FROM perf", "perf"))
def s5(spark, sf_dir):
    path = new_path(spark, "flight-store")
    # Loaded three times, so derived and stored once.
    arrived = new_path(spark, "arrived-flights")
    b.ops_flights(spark, sf_dir, "flight_id", "origin", "destination", "delay_minutes", "is_delayed").write.parquet(arrived)
    flights = spark.read.parquet(arrived)
    files.append_missing(flights.where("is_delayed = 1"), path, "flight_id")
    files.append_missing(flights, path, "flight_id")
    files.append_missing(flights, path, "flight_id")
    return spark.read.parquet(path)


_PREDICTIONS = f"""
    SELECT CASE WHEN l_partkey%37=0 THEN 'X-'||flight_id ELSE flight_id END AS flight_id,
      (l_partkey%100)/100.0::DOUBLE AS delay_probability, CAST(v AS INTEGER) AS version
    FROM (SELECT *, unnest(range(0, l_linenumber%3+1)) AS v FROM perf)"""


@query("s15_key_checks", with_ctes("""
    SELECT 'flight_id_unique' AS rule,
      CAST((SELECT count(*) FROM (SELECT 1 FROM perf GROUP BY flight_id HAVING count(*)>1)) AS BIGINT)
        AS violations
    UNION ALL SELECT 'origin_not_null', CAST(count(*) FILTER (origin IS NULL) AS BIGINT) FROM perf
    UNION ALL SELECT 'destination_not_null', CAST(count(*) FILTER (destination IS NULL) AS BIGINT) FROM perf
    UNION ALL SELECT 'distance_mi_not_null', CAST(count(*) FILTER (distance_mi IS NULL) AS BIGINT) FROM perf
    UNION ALL SELECT 'prediction_flight_exists', CAST(count(*) AS BIGINT) FROM preds
      WHERE flight_id NOT IN (SELECT flight_id FROM perf)""", "perf", preds=_PREDICTIONS))
def s15(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "destination", "distance_mi")
    return quality.key_checks(
        flights, b.predictions(spark, sf_dir), ["origin", "destination", "distance_mi"]
    )


@query("p1_filtered_list", with_ctes("""
    SELECT flight_id, origin, destination, is_delayed, delay_minutes FROM perf
    WHERE origin='ATL' AND is_delayed=1 ORDER BY flight_id LIMIT 50""", "perf"))
def p1(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "destination", "is_delayed", "delay_minutes")
    return op.list_flights(flights, origin="atl", is_delayed=True)


_WIDE_ID = r"^[A-Z0-9\-]{2,64}$"


@query("p2_point_lookup", with_ctes(r"""
    SELECT asked AS request_id, upper(asked) AS flight_id,
      regexp_matches(upper(asked), '^[A-Z0-9\-]{2,64}$') AS valid,
      p.flight_id IS NOT NULL AS found, origin, is_delayed
    FROM (SELECT CASE l_linenumber WHEN 1 THEN flight_id||'!' WHEN 2 THEN 'x-'||flight_id
                 ELSE flight_id END AS asked FROM perf) r
    LEFT JOIN perf p ON p.flight_id = upper(asked)
      AND regexp_matches(upper(asked), '^[A-Z0-9\-]{2,64}$')""", "perf"))
def p2(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "is_delayed")
    line = F.split("flight_id", "-")[1]
    asked = b.ops_flights(spark, sf_dir, "flight_id").select(
        F.when(line == "1", F.concat("flight_id", F.lit("!")))
        .when(line == "2", F.concat(F.lit("x-"), "flight_id"))
        .otherwise(F.col("flight_id")).alias("flight_id")
    ).withColumn("request_id", F.col("flight_id"))
    return op.find_flights(asked, flights, _WIDE_ID)


def _variants(modulus: int, default: str, *cases: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cases))
    return f"CASE l_partkey%{modulus} {whens} ELSE {default} END"


_ISO = "'2024-01-'||lpad((l_partkey%28+1)::VARCHAR,2,'0')||'T'||lpad((l_partkey%24)::VARCHAR,2,'0')||':30:00'"
REQUESTS = f"""
    SELECT flight_id AS request_id,
      {_variants(11, 'origin', 'lower(origin)', "' '||origin||' '", 'substr(origin,1,2)', "'ZZZ'")} AS origin,
      {_variants(13, 'destination', 'lower(destination)', "'ZZZ'", "'4'||substr(destination,2,2)")} AS destination,
      {_variants(17, 'iso', "replace(iso,'T',' ')", "'2024-02-30T08:00:00'", "' '||iso||' '")}
        AS scheduled_departure,
      {_variants(7, 'airline', 'lower(airline)', "'XX'")} AS airline,
      {_variants(19, 'aircraft_type', "'Concorde'", 'lower(aircraft_type)')} AS aircraft_type,
      CAST(CASE WHEN l_partkey%23=0 THEN 24 ELSE l_partkey%24 END AS INTEGER) AS dep_hour,
      CAST(CASE WHEN l_partkey%29=0 THEN 7 ELSE l_partkey%7 END AS INTEGER) AS day_of_week,
      {_variants(31, 'distance_mi', '0.5', 'NULL', '20000.0')}::DOUBLE AS distance_mi,
      CAST(l_partkey%260 AS INTEGER) AS row_limit
    FROM (SELECT *, {_ISO} AS iso FROM ops)"""
_CODES = "(" + ",".join(f"'{c}'" for c in dims.ALL_CODES) + ")"
_ISO_OK = r"regexp_full_match(d, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}')"
# DuckDB's parser tolerates surrounding blanks; the accepted form does not.
_TS = f"(CASE WHEN {_ISO_OK} THEN try_strptime(d, '%Y-%m-%dT%H:%M:%S') END)"


def _in(values) -> str:
    return "(" + ",".join(f"'{v}'" for v in values) + ")"


VALIDATED = f"""
    SELECT request_id, o AS origin, t AS destination, a AS airline, aircraft_type,
      d AS scheduled_departure, dep_hour, day_of_week, distance_mi, row_limit,
      concat_ws(',',
        CASE WHEN NOT regexp_full_match(o,'[A-Z]{{3}}') THEN 'origin_format' END,
        CASE WHEN regexp_full_match(o,'[A-Z]{{3}}') AND o NOT IN {_CODES} THEN 'origin_unknown' END,
        CASE WHEN NOT regexp_full_match(t,'[A-Z]{{3}}') THEN 'destination_format' END,
        CASE WHEN regexp_full_match(t,'[A-Z]{{3}}') AND t NOT IN {_CODES} THEN 'destination_unknown' END,
        CASE WHEN NOT {_ISO_OK} THEN 'departure_format' END,
        CASE WHEN {_ISO_OK} AND {_TS} IS NULL THEN 'departure_value' END,
        CASE WHEN a NOT IN {_in(dims.AIRLINES)} THEN 'airline' END,
        CASE WHEN aircraft_type NOT IN {_in(dims.AIRCRAFT_TYPES)} THEN 'aircraft_type' END,
        CASE WHEN dep_hour NOT BETWEEN 0 AND 23 THEN 'dep_hour' END,
        CASE WHEN day_of_week NOT BETWEEN 0 AND 6 THEN 'day_of_week' END,
        CASE WHEN distance_mi NOT BETWEEN 1 AND 15000 THEN 'distance_mi' END,
        CASE WHEN row_limit NOT BETWEEN 1 AND 200 THEN 'row_limit' END) AS errors
    FROM (SELECT *, upper(trim(origin)) AS o, upper(trim(destination)) AS t,
            upper(trim(airline)) AS a, trim(scheduled_departure) AS d FROM requests)"""


@query("p3_p7_validate_requests", with_ctes(VALIDATED, "ops", requests=REQUESTS))
def p3_p7(spark, sf_dir):
    checked = quality.validate_requests(b.requests(spark, sf_dir))
    return checked.withColumn("errors", F.concat_ws(",", "errors"))


@query("p11_on_day", with_ctes("""
    SELECT '2024-01-03' AS asked, dep_hour, CAST(count(*) AS BIGINT) AS flights FROM ops
      WHERE CAST(scheduled_departure AS DATE) = DATE '2024-01-03' GROUP BY dep_hour
    UNION ALL SELECT '2030-01-01', dep_hour, CAST(count(*) AS BIGINT) FROM ops GROUP BY dep_hour""",
    "ops"))
def p11(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "dep_hour", "scheduled_departure")
    parts = [
        op.on_day(flights, day).groupBy("dep_hour").agg(F.count(F.lit(1)).alias("flights"))
        .select(F.lit(day).alias("asked"), "dep_hour", "flights")
        for day in ("2024-01-03", "2030-01-01")
    ]
    return parts[0].unionByName(parts[1])


@query("p12_known_airports", with_ctes("""
    SELECT request_id, origin, destination FROM requests
    WHERE origin IN (SELECT code FROM airports) AND destination IN (SELECT code FROM airports)""",
    "ops", "airports", requests=REQUESTS))
def p12(spark, sf_dir):
    asked = b.requests(spark, sf_dir).select("request_id", "origin", "destination")
    return op.known_airports_only(asked, dims.airports(spark))


@query("p13_skip_bad_rows", with_ctes("""
    SELECT request_id, departure, usable, CASE WHEN usable THEN lat1 END AS o_lat,
      CASE WHEN usable THEN lat2 END AS d_lat
    FROM (SELECT r.*, o.lat AS lat1, t.lat AS lat2,
            departure IS NOT NULL AND o.code IS NOT NULL AND t.code IS NOT NULL AS usable
      FROM parsed r LEFT JOIN airports o ON o.code = r.origin
      LEFT JOIN airports t ON t.code = r.destination)""",
    "ops", "airports", requests=REQUESTS,
    parsed=f"SELECT *, {_TS} AS departure FROM (SELECT *, scheduled_departure AS d FROM requests)"))
def p13(spark, sf_dir):
    good, bad = quality.split_parsable(b.requests(spark, sf_dir), dims.airports(spark))
    missing = F.lit(None).cast("double")
    return good.select("request_id", "departure", "o_lat", "d_lat", F.lit(True).alias("usable")).unionByName(
        bad.select("request_id", "departure", missing.alias("o_lat"), missing.alias("d_lat"),
                   F.lit(False).alias("usable"))
    )


@query("p14_rows_of_top_routes", with_ctes("""
    SELECT flight_id, origin||'→'||destination AS route, delay_cause FROM perf
    WHERE origin||'→'||destination IN (
      SELECT route FROM (SELECT origin||'→'||destination AS route, count(*) AS n FROM perf
        WHERE delay_tenths>0 GROUP BY 1 ORDER BY n DESC, route LIMIT 10))""", "perf"))
def p14(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "destination", "delay_cause", "delay_minutes")
    return op.in_top_delayed_routes(flights).select("flight_id", "route", "delay_cause")


@query("p17_api_projection", with_ctes(
    f"SELECT {', '.join(op.API_COLUMNS)} FROM ops", "ops"))
def p17(spark, sf_dir):
    return op.api_projection(b.ops_flights(spark, sf_dir, *op.API_COLUMNS))


@query("j1_airport_lookup", with_ctes("""
    SELECT origin, flight_id, name, city, lat, lon FROM perf JOIN airports ON code = origin""",
    "perf", "airports"))
def j1(spark, sf_dir):
    return op.with_origin_airport(b.ops_flights(spark, sf_dir, "flight_id", "origin"), dims.airports(spark))


@query("j2_route_airports", with_ctes("""
    SELECT destination, origin, flight_id, o.lat AS o_lat, o.lon AS o_lon, d.lat AS d_lat, d.lon AS d_lon
    FROM perf JOIN airports o ON o.code = origin JOIN airports d ON d.code = destination""",
    "perf", "airports"))
def j2(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "destination")
    return op.with_route_airports(flights, dims.airports(spark))


@query("j7_flight_predictions", with_ctes("""
    SELECT f.flight_id, origin, version, delay_probability, 'joined' AS kind
    FROM perf f LEFT JOIN preds p ON f.flight_id = p.flight_id
    UNION ALL
    SELECT flight_id, NULL, version, delay_probability, 'after_delete' FROM preds
    WHERE flight_id NOT IN (SELECT flight_id FROM perf WHERE is_delayed=1)""",
    "perf", preds=_PREDICTIONS))
def j7(spark, sf_dir):
    flights = b.ops_flights(spark, sf_dir, "flight_id", "origin", "is_delayed")
    predictions = b.predictions(spark, sf_dir)
    joined = op.with_predictions(flights, predictions).select(
        "flight_id", "origin", "version", "delay_probability", F.lit("joined").alias("kind"))
    left = op.cascade_delete(predictions, flights.where("is_delayed = 1")).select(
        "flight_id", F.lit(None).cast("string").alias("origin"), "version", "delay_probability",
        F.lit("after_delete").alias("kind"))
    return joined.unionByName(left)


@query("a28_u3_used_airports", with_ctes("""
    SELECT code, lat, lon FROM airports
    WHERE code IN (SELECT origin FROM perf UNION SELECT destination FROM perf)""", "perf", "airports"))
def a28(spark, sf_dir):
    return op.used_airports(b.perf_flights(spark, sf_dir, "origin", "destination"), dims.airports(spark))


@query("u2_airport_coverage", with_ctes("""
    SELECT code FROM airports EXCEPT (SELECT origin FROM perf UNION SELECT destination FROM perf)""",
    "perf", "airports"))
def u2(spark, sf_dir):
    return op.airport_coverage(b.perf_flights(spark, sf_dir, "origin", "destination"), dims.airports(spark))


@query("h1_haversine_distance", with_ctes(f"""
    SELECT DISTINCT origin, destination,
      {rnd(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1)} AS haversine_mi
    FROM perf JOIN airports o ON o.code=origin JOIN airports d ON d.code=destination""",
    "perf", "airports"))
def h1(spark, sf_dir):
    return h2(spark, sf_dir).drop("ellipsoidal_mi")


@query("h2_ellipsoidal_distance")
def h2(spark, sf_dir):
    flights = b.perf_flights(spark, sf_dir, "origin", "destination")
    return op.route_distances(flights, dims.airports(spark))


_FLAT, _RADIUS_MI = 1 / 298.257223563, 6378.137 / 1.609344  # WGS-84, fixed values


@query("h2_ellipsoidal_facts", with_ctes(f"""
    SELECT origin, destination, {rnd(f"{_RADIUS_MI!r}*(s - {_FLAT / 2!r}*((s-sin(s))*pow(sin(p)*cos(q)/cos(s/2),2) + (s+sin(s))*pow(cos(p)*sin(q)/sin(s/2),2)))", 0)}
      AS closed_form_mi, true AS agrees
    FROM (SELECT *, 2*asin(sqrt(pow(sin((b2-b1)/2),2) + cos(b1)*cos(b2)*pow(sin(radians(lon2-lon1)/2),2))) AS s, (b1+b2)/2 AS p, (b2-b1)/2 AS q
      FROM (SELECT DISTINCT origin, destination, atan({1 - _FLAT!r}*tan(radians(o.lat))) AS b1, atan({1 - _FLAT!r}*tan(radians(d.lat))) AS b2,
              o.lon AS lon1, d.lon AS lon2
            FROM perf JOIN airports o ON o.code=origin JOIN airports d ON d.code=destination))""", "perf", "airports"))
def h2_facts(spark, sf_dir):
    """Ellipsoidal distances next to a closed form in reduced latitudes, which differs by feet, not miles."""
    places = dims.airports(spark)
    end = lambda key, n: places.select(
        F.col("code").alias(key), F.atan((1 - _FLAT) * F.tan(F.radians("lat"))).alias(f"b{n}"), F.col("lon").alias(f"lon{n}"))
    routes = h2(spark, sf_dir).join(F.broadcast(end("origin", 1)), "origin").join(F.broadcast(end("destination", 2)), "destination")
    b1, b2 = F.col("b1"), F.col("b2")
    s, p, q = F.col("s"), F.col("p"), F.col("q")
    bend = (s - F.sin(s)) * (F.sin(p) * F.cos(q) / F.cos(s / 2)) ** 2 + (s + F.sin(s)) * (F.cos(p) * F.sin(q) / F.sin(s / 2)) ** 2
    angle = 2 * F.asin(F.sqrt(F.sin((b2 - b1) / 2) ** 2 + F.cos(b1) * F.cos(b2) * F.sin(F.radians(F.col("lon2") - F.col("lon1")) / 2) ** 2))
    told = routes.withColumns({"s": angle, "p": (b1 + b2) / 2, "q": (b2 - b1) / 2}).withColumn("mi", _RADIUS_MI * (s - _FLAT / 2 * bend))
    return told.select(
        "origin", "destination", round_dp(F.col("mi"), 0).alias("closed_form_mi"),
        ((F.abs(F.col("ellipsoidal_mi") - F.col("mi")) < 0.2) & (F.abs(F.col("haversine_mi") / F.col("ellipsoidal_mi") - 1) < 0.006)).alias("agrees"))


@query("h3_h8_flight_derivation", with_ctes("""
    SELECT flight_id, duration_min AS flight_minutes, scheduled_arrival, actual_departure, actual_arrival,
      CAST(hour(scheduled_departure) AS INTEGER) AS dep_hour, day_of_week, month,
      delay_minutes >= 15 AS is_delayed, delay_cause, origin||'→'||destination AS route FROM ops""", "ops"))
def h3_h8(spark, sf_dir):
    f = b.ops_flights(spark, sf_dir, "flight_id", "distance_mi", "scheduled_departure", "scheduled_arrival",
                      "actual_departure", "actual_arrival", "delay_minutes", "delay_cause",
                      "origin", "destination")
    start = F.col("scheduled_departure")
    return f.select(
        "flight_id", ff.flight_minutes(F.col("distance_mi")).alias("flight_minutes"),
        "scheduled_arrival", "actual_departure", "actual_arrival",
        F.hour(start).alias("dep_hour"), F.weekday(start).alias("day_of_week"),
        F.month(start).alias("month"), ff.is_delayed(F.col("delay_minutes")).alias("is_delayed"),
        ff.cause_or_none(F.col("delay_minutes"), F.col("delay_cause")).alias("delay_cause"),
        ff.route_label(F.col("origin"), F.col("destination")).alias("route"),
    )


@query("h18_h21_flight_map_rows", with_ctes("""
    SELECT flight_id, flight_number, aircraft_type, origin||'→'||destination AS route,
      CASE WHEN delay_tenths<150 THEN 'on_time' WHEN delay_tenths<600 THEN 'delayed' ELSE 'severe' END AS layer,
      CASE WHEN delay_tenths<150 THEN '#2ea043' WHEN delay_tenths<600 THEN '#d29922' ELSE '#f85149' END AS colour,
      CASE WHEN delay_tenths<150 THEN 0.25 WHEN delay_tenths<600 THEN 0.55 ELSE 0.85 END::DOUBLE AS opacity,
      CASE WHEN delay_tenths<150 THEN 'On-time' ELSE '+'||((delay_tenths+5)//10)||' min' END AS status,
      delay_cause, CAST(CAST(round(CAST(distance_mi AS DECIMAL(18,6)), 0) AS BIGINT) AS VARCHAR) AS distance_text
    FROM ops""", "ops"))
def h18(spark, sf_dir):
    return op.flight_map_rows(b.ops_flights(
        spark, sf_dir, "flight_id", "flight_number", "aircraft_type", "origin", "destination",
        "delay_minutes", "delay_cause", "distance_mi"))


@query("g5_busiest_arcs", with_ctes("""
    SELECT origin AS from_name, destination AS to_name, flights, o_lon||','||o_lat AS origin,
      d_lon||','||d_lat AS destination, CAST(3 AS INTEGER) AS width
    FROM (SELECT origin, destination, CAST(count(*) AS BIGINT) AS flights FROM perf GROUP BY 1, 2
          ORDER BY flights DESC, origin, destination LIMIT 20) JOIN pairs USING (origin, destination)""",
    "perf"))
def g5(spark, sf_dir):
    arcs = op.busiest_arcs(b.perf_flights(spark, sf_dir, "origin", "destination"), dims.airports(spark))
    for c in ("origin", "destination"):
        arcs = arcs.withColumn(c, F.concat_ws(",", F.col(c).cast("array<string>")))
    return arcs
