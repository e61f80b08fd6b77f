"""Rounding that gives the same digits on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_dp(value: Column, places: int) -> Column:
    """Half-up rounding through decimal, so binary noise cannot flip a tie."""
    return F.round(value.cast("decimal(18,6)"), places).cast("double")


def tenths(minutes: Column) -> Column:
    """One-decimal minutes as a whole number of tenths; integer sums are order-free."""
    return F.rint(minutes * 10).cast("bigint")


def mean_of_tenths(total: Column, count: Column, places: int) -> Column:
    return round_dp(total.cast("double") / (count * F.lit(10.0)), places)


def share(part: Column, whole: Column, places: int, scale: float = 1.0) -> Column:
    return round_dp(part.cast("double") * F.lit(scale) / whole, places)
