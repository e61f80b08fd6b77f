"""Column rules for flights: times, delays, causes, labels, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions.numeric import round_dp


def flight_minutes(distance_mi: Column) -> Column:
    """Block time: cruise time plus a fixed taxi allowance, truncated to minutes."""
    return (distance_mi / dims.CRUISE_MPH * 60 + dims.TAXI_MINUTES).cast("int")


def add_minutes(ts: Column, minutes: Column) -> Column:
    """ts + minutes, where minutes may be fractional."""
    return ts + F.make_dt_interval(secs=(minutes * 60).cast("decimal(18,6)"))


def is_delayed(minutes: Column) -> Column:
    return minutes >= dims.DELAY_THRESHOLD_MIN


def cause_or_none(minutes: Column, cause: Column) -> Column:
    return F.when(minutes > 0, cause).otherwise(F.lit(dims.NO_CAUSE))


def route_label(origin: Column, destination: Column) -> Column:
    return F.concat(origin, F.lit("→"), destination)


def period_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))


def _by_delay(minutes: Column, on_time, minor, severe) -> Column:
    return (
        F.when(minutes < dims.DELAY_THRESHOLD_MIN, F.lit(on_time))
        .when(minutes < dims.SEVERE_DELAY_MIN, F.lit(minor))
        .when(minutes.isNotNull(), F.lit(severe))
    )


def delay_band(minutes: Column) -> Column:
    return _by_delay(minutes, "on_time", "delayed", "severe")


def delay_colour(minutes: Column) -> Column:
    return _by_delay(minutes, dims.GREEN, dims.YELLOW, dims.RED)


def delay_opacity(minutes: Column) -> Column:
    return _by_delay(minutes, 0.25, 0.55, 0.85)


def delay_status(minutes: Column) -> Column:
    """`On-time` or `+N min`."""
    whole = F.round(minutes.cast("decimal(18,6)"), 0).cast("bigint")
    return F.when(minutes < dims.DELAY_THRESHOLD_MIN, F.lit("On-time")).otherwise(
        F.concat(F.lit("+"), whole.cast("string"), F.lit(" min"))
    )


def is_peak_hour(hour: Column) -> Column:
    (a, b), (c, d) = dims.PEAK_HOURS
    return hour.between(a, b) | hour.between(c, d)


def congestion_score(
    origin: Column, destination: Column, hour: Column, jitter: bool = False
) -> Column:
    """Hub and peak-hour load in [0, 1]; the optional jitter is a stable hash."""
    tenth_points = (
        F.when(origin.isin(*dims.HUBS), 3).otherwise(0)
        + F.when(destination.isin(*dims.HUBS), 2).otherwise(0)
        + F.when(is_peak_hour(hour), 3).otherwise(0)
    )
    score = tenth_points / F.lit(10.0)
    if jitter:
        score = score + F.pmod(F.xxhash64(origin, destination, hour), F.lit(1_000_000)) / 1e6 * 0.05
    return F.least(score, F.lit(1.0))


def encode_aircraft(aircraft_type: Column) -> Column:
    """Alphabetical code of the aircraft type; unknown types become 0."""
    code = F.lit(0)
    for i, name in enumerate(sorted(dims.AIRCRAFT_TYPES)):
        code = F.when(aircraft_type == name, i).otherwise(code)
    return code.cast("int")


def blended_probability(model_probability: Column, weather_risk: Column) -> Column:
    """0.7 model + 0.3 weather; weather alone where the model gave nothing."""
    return F.when(
        model_probability.isNotNull(),
        round_dp(model_probability * 0.7 + weather_risk * 0.3, 3),
    ).otherwise(round_dp(weather_risk, 3))


def confidence(model_probability: Column) -> Column:
    return F.when(model_probability.isNotNull(), F.lit("high")).otherwise(F.lit("low"))


def expected_delay(probability: Column) -> Column:
    return round_dp(probability * 90.0, 1)


def risk_label(probability: Column) -> Column:
    return (
        F.when(probability > 0.6, F.lit("HIGH"))
        .when(probability > 0.35, F.lit("MODERATE"))
        .when(probability.isNotNull(), F.lit("LOW"))
    )


def probability_colour(probability: Column) -> Column:
    return (
        F.when(probability < 0.30, F.lit(dims.GREEN))
        .when(probability < 0.60, F.lit(dims.YELLOW))
        .when(probability.isNotNull(), F.lit(dims.RED))
    )


def probability_weight(probability: Column) -> Column:
    return probability * 4.0 + 2.0


def probability_opacity(probability: Column) -> Column:
    return probability * 0.5 + 0.4


def or_default(text: Column, default) -> Column:
    """Empty text counts as missing."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(text, F.lit("")), default)


def fixed(value: Column, places: int) -> Column:
    """A number as text with a fixed count of decimals, rounded half up."""
    return F.round(value.cast("decimal(18,6)"), places).cast(f"decimal(18,{places})").cast("string")


def weather_summary(wind: Column, visibility: Column, precipitation: Column, risk: Column) -> Column:
    return F.concat(
        F.lit("Origin: wind "), fixed(wind, 0), F.lit(" kn, vis "), fixed(visibility, 1),
        F.lit(" km, precip "), fixed(precipitation, 1), F.lit(" mm/h. Route max risk: "),
        fixed(risk, 2), F.lit("."),
    )


def explanation(model_probability: Column, weather_risk: Column, blended: Column) -> Column:
    with_model = F.concat(
        F.lit("ML model probability "), fixed(model_probability, 2),
        F.lit(" (weight 0.70) combined with weather risk "), fixed(weather_risk, 2),
        F.lit(" (weight 0.30) → "), fixed(blended, 2), F.lit("."),
    )
    without = F.concat(
        F.lit("ML model unavailable — delay probability driven entirely by "
              "live weather risk score "),
        fixed(weather_risk, 2), F.lit("."),
    )
    return F.when(model_probability.isNotNull(), with_model).otherwise(without)
