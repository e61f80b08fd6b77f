"""The delay-prediction job: requests in, blended probabilities and texts out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.functions import flights as ff
from avspark.functions import geo
from avspark.functions.numeric import round_dp
from avspark.functions.weather import RISK_DEFAULTS
from avspark.ml.features import DEFAULT_WEATHER_SCORE, fill_missing_inputs
from avspark.ml.model import DelayModels, score
from avspark.operators import quality, weather
from avspark.operators.lookups import with_route_airports


_NEEDED = ["origin_format", "origin_unknown", "destination_format", "destination_unknown",
           "departure_format", "departure_value", "airline", "aircraft_type"]


def checked_requests(requests: DataFrame) -> DataFrame:
    """Every request with ``errors``: the failed rules of route, time, airline and aircraft."""
    checked = quality.validate_requests(requests)
    return checked.withColumn("errors", F.filter("errors", lambda e: e.isin(_NEEDED)))


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests without such errors, with the parsed time."""
    ok = checked_requests(requests).where(F.size("errors") == 0)
    return ok.withColumn("departure", quality.parsed_time(F.col("scheduled_departure")))


def request_features(requests: DataFrame, live: DataFrame, airports: DataFrame) -> DataFrame:
    """Model inputs of valid requests, from the newest weather at both ends.

    An end without a weather record has the default score, as in training.
    The origin score is the origin's own risk; the larger of both risks is kept apart as
    ``max_risk_score``, which the blend uses.
    """
    placed = with_route_airports(requests.drop("dep_hour", "day_of_week", "distance_mi"), airports)
    seen = weather.route_weather(placed, live, airports, DEFAULT_WEATHER_SCORE)
    hour = F.hour("departure")
    return (
        seen.withColumn("dep_hour", hour)
        .withColumn("day_of_week", F.weekday("departure"))
        .withColumn("origin_weather_score", F.col("origin_risk"))
        .withColumn("dest_weather_score", F.col("destination_risk"))
        .withColumn("distance_mi", round_dp(geo.haversine_mi(
            F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")), 1))
        .withColumn("aircraft_type_encoded", ff.encode_aircraft(F.col("aircraft_type")))
        .withColumn("route_congestion_score", ff.congestion_score(
            F.col("origin"), F.col("destination"), hour))
        .drop("o_lat", "o_lon", "d_lat", "d_lon")
    )


def blend(scored: DataFrame, probability: str | None) -> DataFrame:
    """Final probability, expected delay, label and texts; ``probability=None`` means no model."""
    p = F.col(probability) if probability else F.lit(None).cast("double")
    r = F.col("max_risk_score")
    final = ff.blended_probability(p, r)
    seen = lambda field: F.coalesce(F.col("origin_weather")[field], F.lit(RISK_DEFAULTS[field]))
    return scored.select(
        "request_id", "origin", "destination", final.alias("blended_probability"),
        ff.expected_delay(final).alias("expected_delay_minutes"), r.alias("weather_risk_score"),
        ff.risk_label(final).alias("risk_label"), ff.confidence(p).alias("confidence"),
        ff.weather_summary(seen("wind_speed_knots"), seen("visibility_km"), seen("precipitation_mm_hr"), r)
        .alias("weather_summary"),
        ff.explanation(p, r, final).alias("explanation"),
    )


def predict_delays(
    requests: DataFrame, live: DataFrame, airports: DataFrame, models: DelayModels | None
) -> DataFrame:
    """One row per request: the prediction, or the ``errors`` (comma-joined) that prevent it."""
    features = request_features(valid_requests(requests), live, airports)
    answered = blend(features, None) if models is None else blend(score(features, models), "delay_probability")
    rejected = checked_requests(requests).where(F.size("errors") > 0).select(
        "request_id", "origin", "destination", F.concat_ws(",", "errors").alias("errors"))
    return answered.withColumn("errors", F.lit("")).unionByName(rejected, allowMissingColumns=True)


_ASKED_BY_HOUR = ["origin_format", "destination_format", "aircraft_type", "dep_hour", "day_of_week", "distance_mi"]


def hour_request_features(requests: DataFrame, reports: DataFrame, network: DataFrame, airports: DataFrame) -> DataFrame:
    """Model inputs of requests that name an hour and a weekday instead of a date, and ``errors``.

    Weather is that of the reference day at the hour asked for; the distance is the given one or the
    routes' own. Unknown airports are no error: they have the default score and distance. Requests with
    errors have no inputs.
    """
    checked = quality.validate_requests(requests).withColumn("errors", F.filter("errors", lambda e: e.isin(_ASKED_BY_HOUR)))
    filled = fill_missing_inputs(checked, reports, network, airports)
    usable = F.size("errors") == 0
    inputs = {
        "origin_weather_score": F.col("origin_score"), "dest_weather_score": F.col("destination_score"), "distance_mi": F.col("distance_mi"),
        "aircraft_type_encoded": ff.encode_aircraft(F.col("aircraft_type")),
        "route_congestion_score": ff.congestion_score(F.col("origin"), F.col("destination"), F.col("dep_hour"))}
    return filled.select(
        "request_id", "origin", "destination", "dep_hour", "day_of_week",
        *[F.when(usable, value).alias(name) for name, value in inputs.items()], F.concat_ws(",", "errors").alias("errors"))


def predict_at_hour(
    requests: DataFrame, reports: DataFrame, network: DataFrame, airports: DataFrame, models: DelayModels
) -> DataFrame:
    """One row per request of :func:`hour_request_features`: inputs, delay, probability, interval and label,
    or the errors that prevent them."""
    asked = hour_request_features(requests, reports, network, airports)
    answered = score(asked.where("errors = ''"), models).drop("delayed_predicted").withColumn(
        "risk_label", ff.risk_label(F.col("delay_probability")))
    return answered.unionByName(asked.where("errors <> ''"), allowMissingColumns=True)
