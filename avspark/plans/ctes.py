"""Shared SQL building blocks of the oracle: the domain tables, in DuckDB SQL.

Written independently of the DataFrame code; both sides only share the fixed values.
"""

from __future__ import annotations

from avspark import dims


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _airport_rows() -> str:
    rows = []
    for i, (code, lat, lon) in enumerate(dims.AIRPORTS):
        name, city = dims.AIRPORT_NAMES.get(code, (None, None))
        text = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
        rows.append(f"('{code}', {i}, {lat!r}::DOUBLE, {lon!r}::DOUBLE, {text(name)}, {text(city)})")
    return ", ".join(rows)


def rnd(expr: str, places: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def fixed(expr: str, places: int) -> str:
    return f"CAST(CAST(round(CAST({expr} AS DECIMAL(18,6)),{places}) AS DECIMAL(18,{places})) AS VARCHAR)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2*{dims.EARTH_RADIUS_MI}*asin(sqrt(pow(sin(radians({lat2}-{lat1})/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2))))"
    )


def sector(lat: str, lon: str) -> str:
    return (
        f"CASE WHEN {lat}>=25 AND {lat}<50 AND {lon}>=-125 AND {lon}<-65 THEN "
        f"CAST(floor(({lat}-25)/6.25)*5+floor(({lon}+125)/12) AS INTEGER) END"
    )


def great_circle(source: str, n: int) -> str:
    """Points along each row of ``source`` (needs o_lat, o_lon, d_lat, d_lon)."""
    frac = f"i/{float(n - 1)}" if n > 1 else "0.0"
    return f"""
    SELECT * EXCLUDE (ax,ay,az,bx,by_,bz,w,x,y,z,p,q),
      degrees(asin(greatest(-1.0,least(1.0,z/sqrt(x*x+y*y+z*z))))) AS lat,
      degrees(atan2(y/sqrt(x*x+y*y+z*z),x/sqrt(x*x+y*y+z*z))) AS lon
    FROM (SELECT *, p*ax+q*bx AS x, p*ay+q*by_ AS y, p*az+q*bz AS z FROM (
      SELECT *, CASE WHEN w<1e-10 THEN 1.0 ELSE sin((1-frac)*w)/sin(w) END AS p,
             CASE WHEN w<1e-10 THEN 0.0 ELSE sin(frac*w)/sin(w) END AS q
      FROM (SELECT v.*, CAST(g.i AS INTEGER) AS i, CAST({frac} AS DOUBLE) AS frac FROM (
        SELECT *, acos(greatest(-1.0,least(1.0,ax*bx+ay*by_+az*bz))) AS w FROM (
          SELECT *, cos(radians(o_lat))*cos(radians(o_lon)) AS ax,
            cos(radians(o_lat))*sin(radians(o_lon)) AS ay, sin(radians(o_lat)) AS az,
            cos(radians(d_lat))*cos(radians(d_lon)) AS bx,
            cos(radians(d_lat))*sin(radians(d_lon)) AS by_, sin(radians(d_lat)) AS bz
          FROM {source})) v, range({n}) g(i))))
    """


_HUBS = "(" + ", ".join(f"'{h}'" for h in dims.HUBS) + ")"
_STORM = "(" + ", ".join(str(c) for c in dims.STORM_CODES) + ")"


def congestion(o: str, d: str, h: str) -> str:
    return (
        f"((CASE WHEN {o} IN {_HUBS} THEN 3 ELSE 0 END)+(CASE WHEN {d} IN {_HUBS} THEN 2 ELSE 0 END)"
        f"+(CASE WHEN {h} BETWEEN 7 AND 9 OR {h} BETWEEN 16 AND 19 THEN 3 ELSE 0 END))/10.0::DOUBLE"
    )


def risk(p: str = "") -> str:
    return (
        f"least((CASE WHEN {p}wind_speed_knots>25 THEN 30 ELSE 0 END)"
        f"+(CASE WHEN {p}visibility_km<4.828 THEN 30 ELSE 0 END)"
        f"+(CASE WHEN {p}precipitation_mm_hr>0.1 THEN 20 ELSE 0 END)"
        f"+(CASE WHEN {p}cloud_cover_pct>80 THEN 10 ELSE 0 END)"
        f"+(CASE WHEN {p}weather_code IN {_STORM} THEN 40 ELSE 0 END),100)/100.0::DOUBLE"
    )


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "airports": ((), f"""
        SELECT * FROM (VALUES {_airport_rows()}) t(code, ord, lat, lon, name, city)"""),
    "network": (("airports",), "SELECT * FROM airports WHERE ord < 25"),
    "perf0": ((), f"""
        SELECT *, CASE WHEN c_nationkey = s_nationkey
                       THEN {_list(dims.NETWORK_CODES)}[(c_nationkey+1+l_partkey%24)%25+1]
                       ELSE {_list(dims.NETWORK_CODES)}[c_nationkey+1] END AS destination,
          {_list(dims.NETWORK_CODES)}[s_nationkey+1] AS origin,
          CASE l_returnflag WHEN 'R' THEN cents%3001 WHEN 'A' THEN cents%601 ELSE 0 END AS delay_tenths
        FROM (SELECT *, CAST(round(l_extendedprice*100) AS BIGINT) AS cents FROM lineitem)
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey"""),
    "pairs": (("network",), f"""
        SELECT o.code AS origin, d.code AS destination, o.lat AS o_lat, o.lon AS o_lon,
               d.lat AS d_lat, d.lon AS d_lon,
               {rnd(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1)} AS distance_mi
        FROM network o, network d WHERE o.code <> d.code"""),
    "perf": (("perf0", "pairs"), f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents,
                         strftime(l_shipdate, '%Y%m%d')) AS flight_id,
          CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
          CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
          CAST(isodow(o_orderdate)-1 AS INTEGER) AS day_of_week,
          CAST(l_partkey%24 AS INTEGER) AS dep_hour,
          {_list(dims.CARRIERS)}[l_suppkey%10+1] AS carrier, f.origin, f.destination, p.distance_mi,
          delay_tenths/10.0::DOUBLE AS delay_minutes,
          CAST(delay_tenths>=150 AS INTEGER) AS is_delayed,
          CASE WHEN delay_tenths>0 THEN {_list(dims.DELAY_CAUSES)}[l_partkey%5+1] ELSE 'none' END
            AS delay_cause,
          delay_tenths, o_orderdate, l_partkey, l_suppkey, l_linenumber
        FROM perf0 f LEFT JOIN pairs p ON f.origin=p.origin AND f.destination=p.destination"""),
    "ops": (("perf",), f"""
        SELECT *, sched AS scheduled_departure, arr AS scheduled_arrival,
          sched + to_seconds(CAST(delay_tenths*6 AS INTEGER)) AS actual_departure,
          arr + to_seconds(CAST(delay_tenths*6 + l_partkey%10*60 AS INTEGER)) AS actual_arrival,
          CAST(isodow(sched)-1 AS INTEGER) AS day_of_week, CAST(month(sched) AS INTEGER) AS month,
          airline || (100 + l_partkey%9899) AS flight_number
        FROM (SELECT *, sched + to_minutes(duration_min) AS arr FROM (
          SELECT * EXCLUDE (year, month, day_of_month, day_of_week),
            {_list(dims.AIRLINES)}[l_suppkey%8+1] AS airline,
            {_list(dims.AIRCRAFT_TYPES)}[l_partkey%4+1] AS aircraft_type,
            CAST(trunc(distance_mi/520*60+40) AS INTEGER) AS duration_min,
            TIMESTAMP '2024-01-01' + to_days(CAST(date_diff('day', DATE '1995-01-01',
              CAST(o_orderdate AS DATE))%30 AS INTEGER)) + to_hours(dep_hour)
              + to_minutes(15*(l_linenumber%4)) AS sched
          FROM perf))"""),
    "ev": ((), f"""
        SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
          CAST(round(value*100) AS BIGINT) AS vc,
          {_list(dims.NETWORK_CODES)}[user_id%25+1] AS airport
        FROM events"""),
    "obs": (("ev",), f"""
        SELECT *, CASE WHEN visibility_sm>=3 AND ceiling_ft>=1000 THEN 'VMC'
                       WHEN visibility_sm>=1 AND ceiling_ft>=500 THEN 'MVMC' ELSE 'IMC' END AS conditions,
          {rnd('''greatest(0.0,least(1.0,
              0.4*least(1.0,greatest(0.0,1.0-visibility_sm/10.0)*1.5)
             +0.4*least(1.0,greatest(0.0,1.0-ceiling_ft/5000.0)*2.0)
             +0.2*least(1.0,wind_speed_kts/40.0)))''', 3)} AS weather_impact_score
        FROM (SELECT airport, date_trunc('hour', ts) AS ts, CAST(hour(date_trunc('hour', ts)) AS INTEGER) AS hour,
            min(vc%96+5)/10.0::DOUBLE AS visibility_sm,
            CAST(200+min(k)*100 AS INTEGER) AS ceiling_ft,
            max(event_id*37%500)/10.0::DOUBLE AS wind_speed_kts,
            CAST(max(event_id*13%360) AS DOUBLE) AS wind_dir_deg
          FROM ev GROUP BY ALL)"""),
    "live": (("ev",), """
        SELECT event_id, ts, airport, (event_id*7%400)/10.0::DOUBLE-5 AS temperature_c,
          (event_id*37%500)/10.0::DOUBLE AS wind_speed_knots, (k%20)/10.0::DOUBLE AS precipitation_mm_hr,
          (vc%200)/10.0::DOUBLE AS visibility_km, CAST(k AS DOUBLE) AS cloud_cover_pct,
          CAST([0,3,61,80,95,99][event_id%6+1] AS INTEGER) AS weather_code
        FROM ev"""),
    "latest_live": (("live",), f"""
        SELECT *, {risk()} AS risk_score FROM live
        QUALIFY row_number() OVER (PARTITION BY airport ORDER BY ts DESC, event_id DESC) = 1"""),
    "states": (("ev",), """
        SELECT *, altitude_m < 30 AS on_ground FROM (
          SELECT event_id, ts, lpad(format('{:x}', user_id), 6, '0') AS icao24,
            CASE WHEN event_id%11=0 THEN '' ELSE upper(substr(event_type,1,3))||user_id END AS callsign,
            ['United States','Canada','Mexico'][event_id%3+1] AS origin_country,
            -127 + (event_id*104729%6500)/100.0::DOUBLE AS longitude,
            CASE WHEN event_id%97<>0 THEN 23 + (event_id*7919%2900)/100.0::DOUBLE END AS latitude,
            CAST(vc*7%12193 AS DOUBLE) AS baro_altitude,
            CASE WHEN k%10=0 THEN NULL WHEN k%10=1 THEN 0.0
                 ELSE CAST((vc*7+50)%12193 AS DOUBLE) END AS geo_altitude,
            coalesce(nullif(CASE WHEN k%10=0 THEN NULL WHEN k%10=1 THEN 0.0
                 ELSE CAST((vc*7+50)%12193 AS DOUBLE) END, 0),
                 nullif(CAST(vc*7%12193 AS DOUBLE), 0), 0) AS altitude_m,
            60 + (k*21)/10.0::DOUBLE AS velocity_mps,
            CAST(event_id*13%360 AS DOUBLE) AS heading_deg
          FROM ev)"""),
    "bounds": (("obs",), "SELECT airport, min(ts) AS lo, max(ts) AS hi FROM obs GROUP BY airport"),
}


def with_ctes(body: str, *needs: str, **extra: str) -> str:
    """``body`` prefixed by the domain tables it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
