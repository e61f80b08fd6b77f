"""Great-circle routes: waypoints, nearest-airport weather, route risk.

Geometry depends only on the route, so it is computed once per distinct route (at most
2,450 for 50 airports) and then joined; flights never pass through trigonometry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import geo
from avspark.functions.numeric import round_dp
from avspark.operators import weather
from avspark.operators.lookups import with_route_airports

N_WAYPOINTS = 20
_ROUTE = ["origin", "destination"]


def distinct_routes(flights: DataFrame, airports: DataFrame) -> DataFrame:
    return with_route_airports(flights.select(*_ROUTE).distinct(), airports)


def route_points(routes: DataFrame, n: int = N_WAYPOINTS) -> DataFrame:
    """(origin, destination, i, lat, lon): ``n`` points along each route."""
    return geo.along_great_circle(routes, n).select(*_ROUTE, "i", "lat", "lon")


def with_path_distance(points: DataFrame, miles=geo.haversine_mi) -> DataFrame:
    """Adds the segment and running distance. A window holds one route's n points."""
    along = Window.partitionBy(*_ROUTE).orderBy("i")
    previous = points.withColumn("_lat", F.lag("lat").over(along)).withColumn(
        "_lon", F.lag("lon").over(along)
    )
    segment = F.coalesce(miles(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")), F.lit(0.0))
    return (
        previous.withColumn("segment_mi", segment)
        .withColumn("path_mi", F.sum("segment_mi").over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .drop("_lat", "_lon")
    )


def with_nearest_airport(points: DataFrame, table=dims.NETWORK) -> DataFrame:
    """Adds nearest_airport and its distance."""
    return (
        points.withColumn("_near", geo.nearest_airport(F.col("lat"), F.col("lon"), table))
        .withColumn("nearest_airport", F.col("_near.code"))
        .withColumn("nearest_mi", F.col("_near.dist"))
        .drop("_near")
    )


def _in_reach() -> Column:
    return F.col("nearest_mi") < dims.NEAREST_AIRPORT_MAX_MI


def annotated_waypoints(
    flights: DataFrame, reports: DataFrame, airports: DataFrame,
    at: str = "2024-01-01 07:00:00", n: int = N_WAYPOINTS,
) -> DataFrame:
    """Waypoints of each distinct route with distances and weather at one time."""
    points = with_nearest_airport(
        with_path_distance(route_points(distinct_routes(flights, airports), n))
    )
    now = weather.conditions_at(reports, airports, at, ("weather_impact_score",)).select(
        F.col("airport").alias("nearest_airport"), "weather_impact_score"
    )
    # One row per airport of the fixed dimension.
    joined = points.join(F.broadcast(now), "nearest_airport", "left")
    impact = F.when(_in_reach(), F.coalesce("weather_impact_score", F.lit(0.0))).otherwise(0.0)
    return joined.select(
        *_ROUTE, "i", round_dp(F.col("lat"), 4).alias("lat"), round_dp(F.col("lon"), 4).alias("lon"),
        round_dp(F.col("path_mi"), 1).alias("distance_from_origin_mi"),
        round_dp(impact, 3).alias("weather_impact_score"), "nearest_airport",
        round_dp(F.col("nearest_mi"), 1).alias("dist_to_nearest_apt_mi"),
    )


def nested_paths(routes: DataFrame, n: int = N_WAYPOINTS) -> DataFrame:
    """One row per route with its points as an ordered array (n entries)."""
    rounded = route_points(routes, n).select(
        *_ROUTE, "i", round_dp(F.col("lat"), 4).alias("lat"), round_dp(F.col("lon"), 4).alias("lon")
    )
    return rounded.groupBy(*_ROUTE).agg(
        F.array_sort(F.collect_list(F.struct("i", "lat", "lon"))).alias("path")
    )


def _airports_along(routes: DataFrame, n: int) -> DataFrame:
    """(route, airport, points, n): how many of a route's points each airport's weather covers.

    Impact depends on the nearest airport only, so a route shrinks from n points to the
    handful of airports it passes. Points out of reach of any airport count as calm.
    """
    reach = with_nearest_airport(route_points(routes, n)).withColumn(
        "airport", F.when(_in_reach(), F.col("nearest_airport"))
    )
    return reach.groupBy(*_ROUTE, "airport").agg(F.count(F.lit(1)).alias("points"))


def _risk_columns(n: int, threshold: float) -> list[Column]:
    """Risk aggregates over (impact, points) rows of one route and time."""
    milli = F.rint(F.coalesce(F.col("impact"), F.lit(0.0)) * 1000).cast("bigint")
    impacted = F.sum(F.when(milli > int(round(threshold * 1000)), F.col("points")).otherwise(0))
    mean = F.sum(milli * F.col("points")).cast("double") / F.lit(1000.0 * n)
    worst = F.max(milli) / F.lit(1000.0)
    blend = worst * 0.5 + mean * 0.3 + impacted / F.lit(float(n)) * 0.2
    return [
        round_dp(F.least(F.lit(1.0), F.greatest(F.lit(0.0), blend)), 3).alias("risk_score"),
        worst.alias("max_weather_impact"),
        round_dp(mean, 3).alias("mean_weather_impact"),
        impacted.alias("weather_impacted_waypoints"),
    ]


def risk_at_times(
    keys: DataFrame, reports: DataFrame, airports: DataFrame,
    n: int = N_WAYPOINTS, threshold: float = dims.IMPACT_THRESHOLD,
) -> DataFrame:
    """Risk of each (origin, destination, ts) in ``keys`` (distinct rows).

    Every route between the given airports is prepared once and broadcast: airports are
    a fixed dimension, so that table has at most 50*49*n rows.
    """
    table = dims.AIRPORTS
    along = _airports_along(dims.airport_pairs(keys.sparkSession, table), n)
    expanded = keys.join(F.broadcast(along), _ROUTE)
    scored = weather.as_of(
        expanded, reports, airports, airport="airport", ts="ts",
        values={"weather_impact_score": "impact"},
    )
    return scored.groupBy(*_ROUTE, "ts").agg(*_risk_columns(n, threshold))


def route_risk(
    flights: DataFrame, reports: DataFrame, airports: DataFrame,
    at: str = "2024-01-15 09:00:00", **options,
) -> DataFrame:
    """Risk and length of each distinct route at one time."""
    keys = flights.select(*_ROUTE).distinct().withColumn("ts", F.expr(f"timestamp_ntz'{at}'"))
    risk = risk_at_times(keys, reports, airports, **options)
    length = geo.haversine_mi(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon"))
    return with_route_airports(risk, airports).select(
        *_ROUTE, round_dp(length, 1).alias("total_distance_mi"), "risk_score",
        "max_weather_impact", "mean_weather_impact", "weather_impacted_waypoints",
    )


def flight_risk(flights: DataFrame, reports: DataFrame, airports: DataFrame, **options) -> DataFrame:
    """Route risk at each flight's departure.

    Weather changes by the hour, so flights are reduced to distinct (route, hour) keys,
    those are scored, and the scores are joined back. A hot route is split by AQE's skew
    join; the scored side has one row per key.
    """
    hour = F.date_trunc("hour", "scheduled_departure").cast("timestamp_ntz")
    timed = flights.withColumn("ts", hour)
    risk = risk_at_times(timed.select(*_ROUTE, "ts").distinct(), reports, airports, **options)
    return timed.join(risk, [*_ROUTE, "ts"]).select(
        "flight_id", *_ROUTE, F.col("risk_score").alias("route_risk_score"),
        "max_weather_impact", "mean_weather_impact", "weather_impacted_waypoints",
    )
