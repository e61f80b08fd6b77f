"""Great-circle geometry as native Column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avspark import dims


def haversine_mi(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), F.lit(2.0)
    )
    return F.asin(F.sqrt(a)) * (2 * dims.EARTH_RADIUS_MI)


def along_great_circle(df: DataFrame, n: int) -> DataFrame:
    """Add ``n`` evenly spaced points per row, from (o_lat, o_lon) to (d_lat, d_lon).

    Adds ``i`` (0-based), ``frac``, ``lat`` and ``lon``. The end points' unit vectors
    and the angle between them are computed once per row, before the row is expanded.
    """
    kept = df.columns
    frac = f"CAST(i / {float(n - 1)}D AS DOUBLE)" if n > 1 else "0.0D"
    vectors = df.selectExpr(
        *kept,
        "cos(radians(o_lat)) * cos(radians(o_lon)) AS _ax",
        "cos(radians(o_lat)) * sin(radians(o_lon)) AS _ay", "sin(radians(o_lat)) AS _az",
        "cos(radians(d_lat)) * cos(radians(d_lon)) AS _bx",
        "cos(radians(d_lat)) * sin(radians(d_lon)) AS _by", "sin(radians(d_lat)) AS _bz",
    ).selectExpr("*", "acos(greatest(-1D, least(1D, _ax * _bx + _ay * _by + _az * _bz))) AS _w")
    weights = (
        vectors.selectExpr("*", f"explode(sequence(0, {n - 1})) AS i")
        .selectExpr("*", f"{frac} AS frac")
        .selectExpr(
            "*",
            "CASE WHEN _w < 1e-10D THEN 1D ELSE sin((1D - frac) * _w) / sin(_w) END AS _p",
            "CASE WHEN _w < 1e-10D THEN 0D ELSE sin(frac * _w) / sin(_w) END AS _q",
        )
    )
    points = weights.selectExpr("*", *[f"_p * _a{c} + _q * _b{c} AS _{c}" for c in "xyz"]).selectExpr(
        "*", "sqrt(_x * _x + _y * _y + _z * _z) AS _norm"
    )
    return points.selectExpr(
        *kept, "i", "frac",
        "degrees(asin(greatest(-1D, least(1D, _z / _norm)))) AS lat",
        "degrees(atan2(_y / _norm, _x / _norm)) AS lon",
    )


def nearest_airport(lat: Column, lon: Column, table=dims.NETWORK) -> Column:
    """struct(dist, ord, code) of the closest airport; ties go to the lower ordinal.

    The dimension is a constant of at most 50 entries, so the search is a per-row
    array minimum: no join, no shuffle, no row expansion.
    """
    return F.array_min(F.transform(
        dims.airport_array(table),
        lambda a: F.struct(
            haversine_mi(lat, lon, a["lat"], a["lon"]).alias("dist"),
            a["ord"].alias("ord"), a["code"].alias("code"),
        ),
    ))


# WGS-84 ellipsoid
_WGS84_A = 6_378_137.0
_WGS84_F = 1 / 298.257223563
_METRES_PER_MILE = 1609.344


def _ellipsoidal_miles(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Inverse geodesic by fixed-point iteration on the auxiliary sphere."""
    a, f = _WGS84_A, _WGS84_F
    b = a * (1 - f)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    dlon = np.radians(lon2 - lon1)
    lam = dlon.copy()
    same = (lat1 == lat2) & (lon1 == lon2)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(60):
            sin_s = np.hypot(
                np.cos(u2) * np.sin(lam),
                np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam),
            )
            cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_alpha = np.where(sin_s == 0, 0.0, np.cos(u1) * np.cos(u2) * np.sin(lam) / sin_s)
            cos2_alpha = 1 - sin_alpha**2
            cos_2m = np.where(cos2_alpha == 0, 0.0, cos_s - 2 * np.sin(u1) * np.sin(u2) / cos2_alpha)
            c = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
            new = dlon + (1 - c) * f * sin_alpha * (
                sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1))
            )
            done = np.nanmax(np.abs(new - lam), initial=0.0) < 1e-12
            lam = new
            if done:
                break
        k = cos2_alpha * (a * a - b * b) / (b * b)
        big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        d_sigma = big_b * sin_s * (
            cos_2m + big_b / 4 * (
                cos_s * (2 * cos_2m**2 - 1)
                - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)
            )
        )
        miles = b * big_a * (sigma - d_sigma) / _METRES_PER_MILE
    return np.where(same, 0.0, miles)


def ellipsoidal_mi(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """WGS-84 miles. Meant for tables of distinct routes, not for every flight."""
    @F.pandas_udf("double")
    def miles(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_ellipsoidal_miles(*(s.to_numpy(float) for s in (a, b, c, d))))

    return miles(lat1, lon1, lat2, lon2)


def in_live_box(lat: Column, lon: Column) -> Column:
    lat_min, lat_max, lon_min, lon_max = dims.LIVE_BOX
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)


def sector_id(lat: Column, lon: Column) -> Column:
    """Cell number in the half-open sector box, by arithmetic; null outside."""
    lat_min, lat_max, lon_min, lon_max = dims.SECTOR_BOX
    lat_step = (lat_max - lat_min) / dims.SECTOR_ROWS
    lon_step = (lon_max - lon_min) / dims.SECTOR_COLS
    inside = (lat >= lat_min) & (lat < lat_max) & (lon >= lon_min) & (lon < lon_max)
    row = F.floor((lat - lat_min) / lat_step)
    col = F.floor((lon - lon_min) / lon_step)
    return F.when(inside, (row * dims.SECTOR_COLS + col).cast("int"))


def sector_label(sector: Column) -> Column:
    return F.format_string(
        "S%02d(R%dC%d)", sector,
        F.floor(sector / dims.SECTOR_COLS).cast("int"), (sector % dims.SECTOR_COLS).cast("int"),
    )
