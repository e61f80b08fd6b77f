"""Weather scoring rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions.numeric import round_dp

# Field defaults of a live weather record with missing parts (fixed values).
RISK_DEFAULTS = {
    "wind_speed_knots": 0.0,
    "visibility_km": 16.0,
    "precipitation_mm_hr": 0.0,
    "cloud_cover_pct": 0.0,
    "weather_code": 0,
}


def conditions(visibility_sm: Column, ceiling_ft: Column) -> Column:
    return (
        F.when((visibility_sm >= 3) & (ceiling_ft >= 1000), F.lit("VMC"))
        .when((visibility_sm >= 1) & (ceiling_ft >= 500), F.lit("MVMC"))
        .when(visibility_sm.isNotNull() & ceiling_ft.isNotNull(), F.lit("IMC"))
    )


def impact_score(visibility_sm: Column, ceiling_ft: Column, wind_kts: Column) -> Column:
    """0.4 visibility + 0.4 ceiling + 0.2 wind penalties, each clipped to [0, 1]."""
    def clip(c):
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))

    vis = clip(F.greatest(F.lit(0.0), 1.0 - visibility_sm / 10.0) * 1.5)
    ceiling = clip(F.greatest(F.lit(0.0), 1.0 - ceiling_ft / 5000.0) * 2.0)
    wind = F.least(F.lit(1.0), wind_kts / 40.0)
    return round_dp(clip(vis * 0.40 + ceiling * 0.40 + wind * 0.20), 3)


def risk_score(
    wind_speed_knots: Column, visibility_km: Column, precipitation_mm_hr: Column,
    cloud_cover_pct: Column, weather_code: Column,
) -> Column:
    """Additive threshold score capped at 1; missing fields take calm defaults.

    Points are summed as whole hundredths and divided once.
    """
    def known(column, name):
        return F.coalesce(column, F.lit(RISK_DEFAULTS[name]))

    points = (
        F.when(known(wind_speed_knots, "wind_speed_knots") > 25, 30).otherwise(0)
        + F.when(known(visibility_km, "visibility_km") < 4.828, 30).otherwise(0)
        + F.when(known(precipitation_mm_hr, "precipitation_mm_hr") > 0.1, 20).otherwise(0)
        + F.when(known(cloud_cover_pct, "cloud_cover_pct") > 80, 10).otherwise(0)
        + F.when(known(weather_code, "weather_code").isin(*dims.STORM_CODES), 40).otherwise(0)
    )
    return F.least(points, F.lit(100)) / F.lit(100.0)


def marker_colour(condition: Column) -> Column:
    return (
        F.when(condition == "VMC", F.lit("green"))
        .when(condition == "MVMC", F.lit("orange"))
        .when(condition.isNotNull(), F.lit("red"))
    )


def halo_radius_m(impact: Column) -> Column:
    return impact * 150_000 + 50_000
