"""Column rules for live aircraft positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions.numeric import round_dp


def feet(metres: Column) -> Column:
    return metres * dims.FEET_PER_METRE


def knots(metres_per_second: Column) -> Column:
    return round_dp(metres_per_second * dims.KNOTS_PER_MPS, 1)


def kilometres(metres: Column) -> Column:
    return metres / 1000.0


def best_altitude(geometric: Column, barometric: Column) -> Column:
    """First altitude that is neither missing nor zero, else zero."""
    return F.coalesce(
        F.nullif(geometric, F.lit(0.0)), F.nullif(barometric, F.lit(0.0)), F.lit(0.0)
    )


def altitude_band(metres: Column) -> Column:
    return (
        F.when(metres < dims.LOW_ALTITUDE_M, F.lit("low"))
        .when(metres < dims.MID_ALTITUDE_M, F.lit("mid"))
        .when(metres.isNotNull(), F.lit("high"))
    )


def altitude_colour(metres: Column) -> Column:
    """[R, G, B, A] of the altitude band."""
    rgba = {k: F.array(*[F.lit(x) for x in v]) for k, v in dims.ALTITUDE_COLOURS.items()}
    return (
        F.when(metres < dims.LOW_ALTITUDE_M, rgba["low"])
        .when(metres < dims.MID_ALTITUDE_M, rgba["mid"])
        .when(metres.isNotNull(), rgba["high"])
    )
