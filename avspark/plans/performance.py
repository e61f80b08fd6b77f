"""Performance reports: carriers, routes, months, hours, causes."""

from __future__ import annotations

from avspark import dims
from avspark.operators import performance as op
from avspark.plans.ctes import rnd, with_ctes
from avspark.plans.registry import query
from avspark.sources.bindings import ops_flights, perf_flights

_AVG = rnd("sum(delay_tenths)/(10.0::DOUBLE*count(*))", 2)
_AVG4 = rnd("sum(delay_tenths)/(10.0::DOUBLE*count(*))", 4)
_RATE = rnd("sum(is_delayed)/count(*)::DOUBLE", 4)
_N = "CAST(count(*) AS BIGINT)"
_D = "CAST(sum(is_delayed) AS BIGINT)"


@query("a1_on_time_by_carrier", with_ctes(f"""
    SELECT carrier, {_N} AS total_flights, {_D} AS delayed_flights,
      {rnd('(count(*)-sum(is_delayed))/count(*)::DOUBLE', 4)} AS on_time_pct,
      {_AVG} AS avg_delay_minutes, {rnd('median(delay_tenths)/10.0::DOUBLE', 2)} AS median_delay
    FROM perf GROUP BY carrier ORDER BY on_time_pct DESC, carrier""", "perf"))
def a1(spark, sf_dir):
    return op.on_time_by_carrier(perf_flights(spark, sf_dir, "carrier", "delay_minutes", "is_delayed"))


@query("a2_delay_by_route", with_ctes(f"""
    SELECT origin||'→'||destination AS route, origin, destination, {_AVG} AS avg_delay,
      {_N} AS total_flights
    FROM perf GROUP BY origin, destination ORDER BY avg_delay DESC, origin, destination LIMIT 30""",
    "perf"))
def a2(spark, sf_dir):
    return op.delay_by_route(perf_flights(spark, sf_dir, "origin", "destination", "delay_minutes"))


_MONTHLY = f"""
    SELECT year, month, {_N} AS total_flights, {_RATE} AS delay_rate, {_AVG} AS avg_delay
    FROM perf GROUP BY year, month"""


@query("a3_monthly_trends", with_ctes(_MONTHLY, "perf"))
def a3(spark, sf_dir):
    return op.monthly_trends(perf_flights(spark, sf_dir, "year", "month", "delay_minutes", "is_delayed"))


@query("p18_period_label", with_ctes(
    f"SELECT *, printf('%d-%02d', year, month) AS period FROM ({_MONTHLY})", "perf"))
def p18(spark, sf_dir):
    return op.with_period(a3(spark, sf_dir))


@query("a4_w1_delay_cause_distribution", with_ctes(f"""
    SELECT delay_cause, {_N} AS count,
      {rnd('count(*)*100.0::DOUBLE/sum(count(*)) OVER ()', 2)} AS pct
    FROM perf WHERE delay_tenths > 0 GROUP BY delay_cause""", "perf"))
def a4(spark, sf_dir):
    return op.delay_cause_distribution(perf_flights(spark, sf_dir, "delay_minutes", "delay_cause"))


@query("a5_hourly_delay_pattern", with_ctes(f"""
    SELECT dep_hour, {_AVG} AS avg_delay, {_RATE} AS delay_rate, {_N} AS flight_count
    FROM perf GROUP BY dep_hour""", "perf"))
def a5(spark, sf_dir):
    return op.hourly_delay_pattern(perf_flights(spark, sf_dir, "dep_hour", "delay_minutes", "is_delayed"))


_SWEEP = (10_000, 50_000, 500_000, 1_000_000, 2_000_000)


@query("a6_t6_scale_sweep", with_ctes(" UNION ALL ".join(f"""
    SELECT carrier, {_N} AS total_flights,
      {rnd('(count(*)-sum(is_delayed))/count(*)::DOUBLE', 4)} AS on_time_pct, {_AVG} AS avg_delay,
      CAST({n} AS BIGINT) AS row_count
    FROM (SELECT * FROM perf ORDER BY md5(flight_id) LIMIT {n}) GROUP BY carrier"""
    for n in _SWEEP), "perf"))
def a6(spark, sf_dir):
    return op.scale_sweep(
        perf_flights(spark, sf_dir, "flight_id", "carrier", "delay_minutes", "is_delayed"), _SWEEP
    )


@query("a7_overall_stats", with_ctes(f"""
    SELECT {_N} AS total_flights, {_D} AS delayed_flights,
      {rnd('sum(is_delayed)/count(*)::DOUBLE', 3)} AS delay_rate,
      {rnd('sum(delay_tenths)/(10.0::DOUBLE*count(*))', 1)} AS mean_delay_minutes FROM perf""", "perf"))
def a7(spark, sf_dir):
    return op.overall_stats(ops_flights(spark, sf_dir, "delay_minutes", "is_delayed"))


@query("a8_top_delay_routes", with_ctes(f"""
    SELECT origin||'→'||destination AS route, {rnd('exact', 1)} AS avg_delay, flight_count FROM (
      SELECT origin, destination, {_AVG4} AS exact, {_N} AS flight_count FROM perf
      GROUP BY origin, destination ORDER BY exact DESC, origin, destination LIMIT 5)""", "perf"))
def a8(spark, sf_dir):
    return op.top_delay_routes(ops_flights(spark, sf_dir, "origin", "destination", "delay_minutes"))


@query("a9_kpi_row", with_ctes(f"""
    SELECT {_N} AS total_flights, {_D} AS delayed_flights,
      {rnd('sum(is_delayed)/count(*)::DOUBLE', 3)} AS delay_rate,
      {rnd('sum(delay_tenths)/(10.0::DOUBLE*count(*) FILTER (delay_tenths>0))', 1)}
        AS mean_delay_when_delayed FROM perf""", "perf"))
def a9(spark, sf_dir):
    return op.kpi_row(ops_flights(spark, sf_dir, "delay_minutes", "is_delayed"))


@query("a10_cause_shares", with_ctes(f"""
    SELECT delay_cause, {_N} AS n, {rnd('count(*)/sum(count(*)) OVER ()::DOUBLE', 3)} AS share
    FROM perf GROUP BY delay_cause""", "perf"))
def a10(spark, sf_dir):
    return op.cause_shares(ops_flights(spark, sf_dir, "delay_cause"))


@query("a11_mean_delay_by_hour", with_ctes(
    f"SELECT dep_hour, {_AVG4} AS delay_minutes FROM perf GROUP BY dep_hour", "perf"))
def a11(spark, sf_dir):
    return op.mean_delay_by_hour(ops_flights(spark, sf_dir, "dep_hour", "delay_minutes"))


@query("a12_t3_top_routes_by_mean", with_ctes(f"""
    SELECT origin, destination, {_AVG4} AS avg_delay, {_N} AS flights,
      origin||'→'||destination AS route
    FROM perf GROUP BY origin, destination ORDER BY avg_delay DESC, origin, destination LIMIT 10""",
    "perf"))
def a12(spark, sf_dir):
    return op.top_routes_by_mean(ops_flights(spark, sf_dir, "origin", "destination", "delay_minutes"))


_ROUTE_CAUSE = ("origin", "destination", "delay_cause", "delay_minutes")


@query("a13_route_cause_counts", with_ctes(f"""
    SELECT origin, destination, delay_cause, {_N} AS count FROM perf
    GROUP BY origin, destination, delay_cause""", "perf"))
def a13(spark, sf_dir):
    return op.route_cause_counts(ops_flights(spark, sf_dir, "origin", "destination", "delay_cause"))


_TOP_DELAYED = f"""
    SELECT origin||'→'||destination AS route, {_N} AS delayed FROM perf WHERE delay_tenths > 0
    GROUP BY 1 ORDER BY delayed DESC, route LIMIT 10"""


@query("a14_top_delayed_routes", with_ctes(_TOP_DELAYED, "perf"))
def a14(spark, sf_dir):
    return op.top_delayed_routes(ops_flights(spark, sf_dir, "origin", "destination", "delay_minutes"))


_CAUSE_COLUMNS = ", ".join(
    f"CAST(count(*) FILTER (delay_cause='{c}') AS BIGINT) AS {c}" for c in dims.DELAY_CAUSES)


@query("a15_route_cause_pivot", with_ctes(f"""
    SELECT route, {_CAUSE_COLUMNS}, any_value(delayed) AS delayed
    FROM perf JOIN ({_TOP_DELAYED}) ON route = origin||'→'||destination GROUP BY route""", "perf"))
def a15(spark, sf_dir):
    return op.route_cause_pivot(ops_flights(spark, sf_dir, "origin", "destination", "delay_cause"))


_MATRIX_COLUMNS = ", ".join(
    f"coalesce(avg(avg_delay) FILTER (destination='{c}'), 0.0) AS {c}" for c in dims.NETWORK_CODES)


@query("a16_route_delay_matrix", with_ctes(f"""
    SELECT origin, {_MATRIX_COLUMNS} FROM (
      SELECT origin, destination, {_AVG} AS avg_delay FROM perf GROUP BY origin, destination
      ORDER BY avg_delay DESC, origin, destination LIMIT 30) GROUP BY origin""", "perf"))
def a16(spark, sf_dir):
    return op.route_delay_matrix(perf_flights(spark, sf_dir, "origin", "destination", "delay_minutes"))


_HEAT_CELL = "(('0x'||substr(md5(flight_id),{at},4))::BIGINT/65536.0::DOUBLE-0.5)"


@query("a27_delay_heat_grid", with_ctes(f"""
    SELECT CAST(floor((lat+{_HEAT_CELL.format(at=1)})/0.25) AS BIGINT) AS cell_lat,
      CAST(floor((lon+{_HEAT_CELL.format(at=5)})/0.25) AS BIGINT) AS cell_lon,
      {_N} AS points, {rnd('sum(delay_tenths)/1800.0::DOUBLE', 4)} AS weight
    FROM perf JOIN airports ON code = origin WHERE delay_tenths > 0 GROUP BY 1, 2""",
    "perf", "airports"))
def a27(spark, sf_dir):
    return op.delay_heat_grid(
        ops_flights(spark, sf_dir, "flight_id", "origin", "delay_minutes"), dims.airports(spark)
    )


_SUMMARY = {"distance_mi": 1, "delay_minutes": 1, "is_delayed": 0, "dep_hour": 0,
            "day_of_week": 0, "month": 0}


def _summary_sql(column: str, decimals: int) -> str:
    scale = 10 ** decimals
    v = f"CAST(round({column}*{scale}) AS HUGEINT)"
    s1, s2, n = f"CAST(sum({v}) AS DOUBLE)", f"CAST(sum({v}*{v}) AS DOUBLE)", f"count({column})"
    quartiles = ", ".join(
        rnd(f"quantile_cont({v}::DOUBLE, {q})/{scale}", 4) + f" AS {name}"
        for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    return f"""SELECT '{column}' AS metric, CAST({n} AS BIGINT) AS count,
      {rnd(f'{s1}/{n}/{scale}', 4)} AS mean,
      {rnd(f'sqrt(({s2}-{s1}*{s1}/{n})/({n}-1))/{scale}', 4)} AS stddev,
      CAST(min({v}) AS DOUBLE)/{scale} AS min, {quartiles}, CAST(max({v}) AS DOUBLE)/{scale} AS max
      FROM ops"""


@query("a29_numeric_summary", with_ctes(
    " UNION ALL ".join(_summary_sql(c, d) for c, d in _SUMMARY.items()), "ops"))
def a29(spark, sf_dir):
    return op.numeric_summary(ops_flights(spark, sf_dir, *_SUMMARY), _SUMMARY)


@query("a31_path_layer_counts", with_ctes(f"""
    SELECT CASE WHEN delay_tenths<150 THEN 'on_time' WHEN delay_tenths<600 THEN 'delayed'
           ELSE 'severe' END AS layer, {_N} AS flights FROM perf GROUP BY 1""", "perf"))
def a31(spark, sf_dir):
    return op.path_layer_counts(ops_flights(spark, sf_dir, "delay_minutes"))
