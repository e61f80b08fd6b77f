"""Flight filters, lookups and dimension joins.

Airports are a fixed dimension of at most 50 rows, so joins to it are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions import geo
from avspark.functions.numeric import round_dp

ID_PATTERN = r"^[A-Z0-9\-]{2,20}$"
API_COLUMNS = (
    "flight_id", "airline", "flight_number", "aircraft_type", "origin", "destination",
    "distance_mi", "delay_minutes", "delay_cause", "is_delayed", "dep_hour",
)


def list_flights(
    flights: DataFrame, origin: str | None = None, destination: str | None = None,
    is_delayed: bool | None = None, limit: int = 50,
) -> DataFrame:
    """Flights matching all given filters, in id order, at most ``limit`` (1..200)."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    if origin is not None:
        flights = flights.where(F.col("origin") == origin.strip().upper())
    if destination is not None:
        flights = flights.where(F.col("destination") == destination.strip().upper())
    if is_delayed is not None:
        flights = flights.where(F.col("is_delayed") == int(is_delayed))
    return flights.orderBy("flight_id").limit(limit)


def find_flight(flights: DataFrame, flight_id: str, pattern: str = ID_PATTERN) -> DataFrame:
    """The flight with this id; an id of the wrong form matches nothing."""
    wanted = F.upper(F.lit(flight_id))
    return flights.where((F.col("flight_id") == wanted) & wanted.rlike(pattern))


def find_flights(ids: DataFrame, flights: DataFrame, pattern: str = ID_PATTERN) -> DataFrame:
    """Bulk form: each requested id, whether it is well formed, and its flight if any."""
    asked = ids.select(
        F.col("request_id"), F.upper("flight_id").alias("flight_id"),
        F.upper("flight_id").rlike(pattern).alias("valid"),
    )
    found = flights.withColumn("found", F.lit(True))
    return asked.join(
        found.withColumn("valid", F.lit(True)), ["flight_id", "valid"], "left"
    ).withColumn("found", F.coalesce("found", F.lit(False)))


def api_projection(flights: DataFrame) -> DataFrame:
    return flights.select(*API_COLUMNS)


def with_origin_airport(flights: DataFrame, airports: DataFrame) -> DataFrame:
    lookup = airports.select(F.col("code").alias("origin"), "name", "city", "lat", "lon")
    return flights.join(F.broadcast(lookup), "origin")


def with_route_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Adds both end points' coordinates; flights with an unknown end are dropped."""
    for role, prefix in (("origin", "o"), ("destination", "d")):
        lookup = airports.select(
            F.col("code").alias(role), F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon")
        )
        flights = flights.join(F.broadcast(lookup), role)
    return flights


def known_airports_only(flights: DataFrame, airports: DataFrame) -> DataFrame:
    codes = airports.select("code")
    for role in ("origin", "destination"):
        flights = flights.join(F.broadcast(codes.withColumnRenamed("code", role)), role, "left_semi")
    return flights


def used_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Each airport that any route touches. Deduplicated map-side before the union."""
    ends = flights.select(F.explode(F.array("origin", "destination")).alias("code")).distinct()
    return ends.join(F.broadcast(airports.select("code", "lat", "lon")), "code")


def airport_coverage(flights: DataFrame, required: DataFrame) -> DataFrame:
    """Required airports that no flight touches."""
    present = flights.select(F.explode(F.array("origin", "destination")).alias("code")).distinct()
    return required.select("code").distinct().join(present, "code", "left_anti")


def on_day(flights: DataFrame, day: str) -> DataFrame:
    """Flights scheduled on a date; all flights when that date has none."""
    match = F.to_date("scheduled_departure") == F.to_date(F.lit(day))
    any_match = flights.where(match).select(F.lit(1)).limit(1).agg(F.count(F.lit(1))).scalar()
    return flights.where(match | (any_match == 0))


def in_top_delayed_routes(flights: DataFrame, n: int = 10) -> DataFrame:
    """Flights of the n routes with most delayed flights."""
    from avspark.operators.performance import top_delayed_routes

    labelled = flights.withColumn("route", ff.route_label(F.col("origin"), F.col("destination")))
    # n rows, so the semi join needs no shuffle of flights.
    return labelled.join(F.broadcast(top_delayed_routes(flights, n)), "route", "left_semi")


def route_distances(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Spherical and ellipsoidal miles of each distinct route."""
    routes = with_route_airports(flights.select("origin", "destination").distinct(), airports)
    ends = (F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon"))
    return routes.select(
        "origin", "destination",
        round_dp(geo.haversine_mi(*ends), 1).alias("haversine_mi"),
        round_dp(geo.ellipsoidal_mi(*ends), 1).alias("ellipsoidal_mi"),
    )


def busiest_arcs(flights: DataFrame, airports: DataFrame, top_n: int = 20) -> DataFrame:
    """[lon, lat] end points of the routes with most flights."""
    top = (
        flights.groupBy("origin", "destination").agg(F.count(F.lit(1)).alias("flights"))
        .orderBy(F.desc("flights"), "origin", "destination").limit(top_n)
    )
    return with_route_airports(top, airports).select(
        F.col("origin").alias("from_name"), F.col("destination").alias("to_name"), "flights",
        F.array("o_lon", "o_lat").alias("origin"), F.array("d_lon", "d_lat").alias("destination"),
        F.lit(3).alias("width"),
    )


def flight_map_rows(flights: DataFrame) -> DataFrame:
    """Line style and status text of each flight path."""
    delay = F.col("delay_minutes")
    return flights.select(
        "flight_id", "flight_number", "aircraft_type",
        ff.route_label(F.col("origin"), F.col("destination")).alias("route"),
        ff.delay_band(delay).alias("layer"), ff.delay_colour(delay).alias("colour"),
        ff.delay_opacity(delay).alias("opacity"), ff.delay_status(delay).alias("status"),
        "delay_cause", ff.fixed(F.col("distance_mi"), 0).alias("distance_text"),
    )


def with_predictions(flights: DataFrame, predictions: DataFrame) -> DataFrame:
    """Flights with their predictions (one to many, kept when there is none).

    An outer join cannot split a flight that holds a large part of all predictions; an
    inner join can. So matches are joined inside and flights without any are added, found
    by an anti join against the distinct ids.
    """
    matched = flights.join(predictions, "flight_id")
    ids = predictions.select("flight_id").distinct()
    alone = flights.join(ids, "flight_id", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def cascade_delete(predictions: DataFrame, deleted: DataFrame) -> DataFrame:
    """Predictions left after their flights were deleted."""
    return predictions.join(deleted.select("flight_id"), "flight_id", "left_anti")


def network_airports(spark) -> DataFrame:
    return dims.airports(spark, dims.NETWORK)
