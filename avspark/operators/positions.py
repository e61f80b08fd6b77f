"""Live aircraft positions: filters, display tables and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.functions import flights as ff
from avspark.functions import geo, positions
from avspark.functions.numeric import round_dp


def with_coordinates(states: DataFrame) -> DataFrame:
    return states.na.drop(subset=["latitude", "longitude"])


def in_live_box(states: DataFrame) -> DataFrame:
    return states.where(geo.in_live_box(F.col("latitude"), F.col("longitude")))


def live_table(states: DataFrame) -> DataFrame:
    """Display columns: whole feet, knots, Yes/No, dash for a missing callsign."""
    return states.select(
        "icao24", ff.or_default(F.col("callsign"), "—").alias("callsign"),
        F.col("origin_country").alias("country"),
        round_dp(F.col("latitude"), 3).alias("lat"), round_dp(F.col("longitude"), 3).alias("lon"),
        positions.feet(F.col("altitude_m")).cast("int").alias("altitude_ft"),
        positions.knots(F.col("velocity_mps")).alias("speed_kts"),
        round_dp(F.col("heading_deg"), 0).alias("heading_deg"),
        F.when(F.col("on_ground"), F.lit("Yes")).otherwise(F.lit("No")).alias("on_ground"),
    )


def filter_live_table(table: DataFrame, min_altitude_ft: int = 0, callsign: str | None = None) -> DataFrame:
    """Minimum altitude, and an optional callsign pattern (matched in upper case)."""
    out = table.where(F.col("altitude_ft") >= min_altitude_ft)
    return out.where(F.col("callsign").rlike(callsign.upper())) if callsign else out


def map_points(states: DataFrame) -> DataFrame:
    """Point records of the position map."""
    return with_coordinates(states).select(
        F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), "altitude_m",
        round_dp(positions.feet(F.col("altitude_m")), 0).alias("altitude_ft"),
        ff.or_default(F.col("callsign"), F.col("icao24")).alias("callsign"),
        F.col("heading_deg").alias("heading"),
        positions.knots(F.col("velocity_mps")).alias("velocity_knots"),
        positions.altitude_colour(F.col("altitude_m")).alias("color"),
    )


def altitude_band_counts(states: DataFrame) -> DataFrame:
    return states.groupBy(positions.altitude_band(F.col("altitude_m")).alias("band")).agg(
        F.count(F.lit(1)).alias("aircraft")
    )


def live_kpis(states: DataFrame) -> DataFrame:
    """Totals, airborne and ground counts, mean airborne altitude in whole feet."""
    ft = positions.feet(F.col("altitude_m")).cast("bigint")
    airborne = ~F.col("on_ground")
    return states.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(airborne).alias("airborne"),
        F.count_if(F.col("on_ground")).alias("ground"),
        round_dp(
            F.sum(F.when(airborne, ft)).cast("double") / F.count_if(airborne), 1
        ).alias("avg_altitude_ft"),
    )


def altitude_histogram(states: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width bins over the airborne altitude range, in whole feet.

    Altitudes are first counted per foot, so the range and the bins both come from that
    small table and the positions are scanned once.
    """
    from pyspark.sql import Window

    per_foot = (
        states.where("NOT on_ground")
        .groupBy(positions.feet(F.col("altitude_m")).cast("bigint").alias("ft"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everything = Window.partitionBy()
    lo, hi = F.min("ft").over(everything), F.max("ft").over(everything)
    binned = per_foot.select(
        "n", lo.alias("lo"), hi.alias("hi"),
        F.least(F.floor((F.col("ft") - lo) * bins / F.greatest(hi - lo, F.lit(1))), F.lit(bins - 1))
        .cast("int").alias("bin"),
    )
    return binned.groupBy("bin").agg(
        F.sum("n").alias("aircraft"),
        round_dp(F.min(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / float(bins)), 2)
        .alias("from_ft"),
    )
