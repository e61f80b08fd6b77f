"""Delay-prediction inputs: the seven model columns, built without per-row Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.functions import flights as ff
from avspark.functions import geo
from avspark.functions.numeric import round_dp
from avspark.operators import weather

FEATURES = (
    "dep_hour", "day_of_week", "origin_weather_score", "dest_weather_score",
    "distance_mi", "aircraft_type_encoded", "route_congestion_score",
)
# Inputs assumed when a request lacks them (fixed values).
DEFAULT_WEATHER_SCORE = 0.3
DEFAULT_DISTANCE_MI = 1500.0


def _with_pinned_scores(df: DataFrame, reports: DataFrame, airports: DataFrame, day: str,
                        origin: str, destination: str) -> DataFrame:
    """Joins the reference day's hourly impact at both ends.

    The lookup has 24 rows per airport of the fixed dimension (1,200 at most), so it is
    broadcast and flights are not shuffled.
    """
    pinned = weather.pinned_impacts(reports, airports, day)
    for role, name in (("origin", origin), ("destination", destination)):
        side = pinned.select(
            F.col("airport").alias(role), F.col("hour").alias("dep_hour"), F.col("impact").alias(name)
        )
        df = df.join(F.broadcast(side), [role, "dep_hour"], "left")
    return df


def build_features(
    flights: DataFrame, reports: DataFrame, airports: DataFrame,
    day: str = "2024-01-15", as_of: str = "pinned", jitter: bool = False,
) -> DataFrame:
    """Adds the model columns.

    By default weather is read at the departure hour of one reference day; with
    ``as_of='flight'`` it is the weather in force at each flight's own departure.
    Airports without weather get the default score.
    """
    if as_of == "flight":
        scored = weather.flight_weather(flights, reports, airports).withColumnsRenamed(
            {"origin_impact": "origin_weather_score", "destination_impact": "dest_weather_score"}
        )
    else:
        scored = _with_pinned_scores(
            flights, reports, airports, day, "origin_weather_score", "dest_weather_score"
        )
    return (
        scored.na.fill(DEFAULT_WEATHER_SCORE, ["origin_weather_score", "dest_weather_score"])
        .withColumn("aircraft_type_encoded", ff.encode_aircraft(F.col("aircraft_type")))
        .withColumn("route_congestion_score", ff.congestion_score(
            F.col("origin"), F.col("destination"), F.col("dep_hour"), jitter))
    )


def fill_missing_inputs(
    requests: DataFrame, reports: DataFrame, network: DataFrame, airports: DataFrame,
    day: str = "2024-01-15",
) -> DataFrame:
    """Weather scores and distances for requests, with defaults for what is unknown."""
    scored = _with_pinned_scores(requests, reports, network, day, "origin_score", "destination_score")
    for role, prefix in (("origin", "o"), ("destination", "d")):
        side = airports.select(
            F.col("code").alias(role), F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon")
        )
        scored = scored.join(F.broadcast(side), role, "left")
    measured = round_dp(
        geo.haversine_mi(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")), 1)
    return (
        scored.na.fill(DEFAULT_WEATHER_SCORE, ["origin_score", "destination_score"])
        .withColumn("distance_mi", F.coalesce(
            F.col("distance_mi"), measured, F.lit(DEFAULT_DISTANCE_MI)))
        .drop("o_lat", "o_lon", "d_lat", "d_lon")
    )
