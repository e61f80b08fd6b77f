"""Airspace sector load from scheduled flights.

Flights are counted per (route, departure hour, duration) before any path is expanded:
at most a few hundred thousand rows leave the scan however many flights there are, and
a busy route is one counted row like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions import geo

N_POSITIONS = 30
_ROUTE = ["origin", "destination"]


def sector_grid(spark: SparkSession) -> DataFrame:
    """The 20 sectors with their bounds and labels."""
    lat_min, lat_max, lon_min, lon_max = dims.SECTOR_BOX
    lat_step = (lat_max - lat_min) / dims.SECTOR_ROWS
    lon_step = (lon_max - lon_min) / dims.SECTOR_COLS
    row = F.floor(F.col("sector_id") / dims.SECTOR_COLS).cast("int")
    col = (F.col("sector_id") % dims.SECTOR_COLS).cast("int")
    return (
        spark.range(dims.N_SECTORS).select(F.col("id").cast("int").alias("sector_id"))
        .select(
            "sector_id", row.alias("row"), col.alias("col"),
            (row * lat_step + lat_min).alias("lat_lo"), ((row + 1) * lat_step + lat_min).alias("lat_hi"),
            (col * lon_step + lon_min).alias("lon_lo"), ((col + 1) * lon_step + lon_min).alias("lon_hi"),
            geo.sector_label(F.col("sector_id")).alias("sector"),
        )
    )


def in_sectors(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Adds sector_id (null outside the grid)."""
    return points.withColumn("sector_id", geo.sector_id(F.col(lat), F.col(lon)))


def positions_per_sector(points: DataFrame, spark: SparkSession) -> DataFrame:
    """The grid with the number of given positions in each sector."""
    counts = in_sectors(points).groupBy("sector_id").agg(F.count(F.lit(1)).alias("positions"))
    return sector_grid(spark).join(F.broadcast(counts), "sector_id", "left").na.fill(0, ["positions"])


def flights_per_leg(flights: DataFrame) -> DataFrame:
    """Flights counted per route, departure hour and block time."""
    return flights.groupBy(
        *_ROUTE, "dep_hour", ff.flight_minutes(F.col("distance_mi")).alias("duration_min")
    ).agg(F.count(F.lit(1)).alias("flights"))


def path_points(spark: SparkSession, n: int = N_POSITIONS, table=dims.AIRPORTS) -> DataFrame:
    """(origin, destination, i, frac, lat, lon, sector_id) for every airport pair.

    At most 50*49*n rows, fixed by the airport dimension. It is computed while the
    flights are still being counted and then broadcast.
    """
    points = geo.along_great_circle(dims.airport_pairs(spark, table), n)
    return points.select(
        *_ROUTE, "i", "frac", "lat", "lon", geo.sector_id(F.col("lat"), F.col("lon")).alias("sector_id")
    )


def _clock_hour() -> Column:
    """Hour of day at a point of a leg: whole hours elapsed since departure, wrapped."""
    elapsed = F.floor(F.col("frac") * F.col("duration_min") / 60).cast("int")
    return F.pmod(F.col("dep_hour") + elapsed, F.lit(24))


def leg_positions(legs: DataFrame, n: int = N_POSITIONS, table=dims.AIRPORTS) -> DataFrame:
    """Positions along each leg with the clock hour they fall in.

    ``legs`` has origin, destination, dep_hour, duration_min and flights.
    """
    points = F.broadcast(path_points(legs.sparkSession, n, table))
    return legs.join(points, _ROUTE).withColumn("hour", _clock_hour())


def _crossings(legs: DataFrame, n: int, table) -> DataFrame:
    """Points of each leg in each (sector, hour) it crosses, with the leg's flights."""
    return (
        # Points outside the grid become -1 and fall away in the final join.
        leg_positions(legs, n, table)
        .groupBy(*_ROUTE, "dep_hour", "duration_min",
                 F.coalesce("sector_id", F.lit(-1)).alias("sector_id"), "hour")
        .agg(F.count(F.lit(1)).alias("points"), F.max("flights").alias("flights"))
    )


def sector_load_by_day(flights: DataFrame, n: int = N_POSITIONS, table=dims.AIRPORTS) -> DataFrame:
    """Dense day x sector x hour load of the flights that leave on each day (UTC).

    As in a day's own plan, hours past midnight wrap to the day of departure. Flights without a time
    are on no day. Which cells a leg crosses does not depend on the day: that is worked out once for each
    (route, hour, duration) and joined to the days' counts of flights.
    """
    shape = [*_ROUTE, "dep_hour", "duration_min"]
    legs = (
        flights.where(F.col("scheduled_departure").isNotNull())
        .groupBy(F.to_date("scheduled_departure").alias("day"), *_ROUTE, "dep_hour",
                 ff.flight_minutes(F.col("distance_mi")).alias("duration_min"))
        .agg(F.count(F.lit(1)).alias("flights")))
    shapes = legs.select(*shape).distinct().withColumn("flights", F.lit(1))
    crossed = _crossings(shapes, n, table).drop("flights").where("sector_id >= 0")
    load = legs.join(crossed, shape).groupBy("day", "sector_id", "hour").agg(
        F.sum(F.col("points") * F.col("flights")).alias("positions"), F.sum("flights").alias("distinct_flights"))
    # One row for each day of the calendar that has flights.
    cells = legs.select("day").distinct().select("day", F.explode(F.sequence(F.lit(0), F.lit(20 * 24 - 1))).alias("cell"))
    grid = cells.select("day", F.expr("cast(cell div 24 as int)").alias("sector_id"), (F.col("cell") % 24).alias("hour"))
    return (
        grid.join(load, ["day", "sector_id", "hour"], "left").na.fill(0, ["positions", "distinct_flights"])
        .withColumn("sector", geo.sector_label(F.col("sector_id"))))


def sector_load(flights: DataFrame, n: int = N_POSITIONS, table=dims.AIRPORTS) -> DataFrame:
    """Dense sector x hour load: counted positions, and distinct flights.

    A flight's path crosses the same cells as every other flight of its leg, so distinct
    flights are the sum of the legs' counts; no flight id is ever collected.
    """
    crossed = _crossings(flights_per_leg(flights), n, table)
    load = crossed.groupBy("sector_id", "hour").agg(
        F.sum(F.col("points") * F.col("flights")).alias("positions"),
        F.sum("flights").alias("distinct_flights"),
    )
    return densify(load, flights.sparkSession, ["positions", "distinct_flights"])


def densify(load: DataFrame, spark: SparkSession, counts: list[str]) -> DataFrame:
    """All 20 x 24 sector-hours, zero where there was no traffic."""
    grid = sector_grid(spark).select(
        "sector_id", "sector", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    )
    # One row per cell and hour at most.
    return grid.join(F.broadcast(load), ["sector_id", "hour"], "left").na.fill(0, counts)


def overloaded(load: DataFrame, threshold: int = dims.SECTOR_OVERLOAD, by: tuple[str, ...] = ()) -> DataFrame:
    """Sector-hours at or over the threshold, busiest first; ``by=("day",)`` for the load of days."""
    return (
        load.where(F.col("positions") >= threshold)
        .select(*by, "sector", "hour", F.col("positions").alias("aircraft_count"),
                F.lit("FLOW CONTROL").alias("alert"))
        .orderBy(*by, F.desc("aircraft_count"), "sector", "hour")
    )


def peak(load: DataFrame, threshold: int = dims.SECTOR_OVERLOAD, by: tuple[str, ...] = ()) -> DataFrame:
    """The busiest sector-hour (first in sector, hour order) and the overload count."""
    rank = F.struct("positions", -F.col("sector_id"), -F.col("hour"))
    top = F.max_by(F.struct("sector", "hour", "positions"), rank)
    return load.groupBy(*by).agg(
        top.alias("_top"), F.count_if(F.col("positions") >= threshold).alias("overloaded_count")
    ).select(
        *by, F.col("_top.sector").alias("peak_sector"), F.col("_top.hour").alias("peak_hour"),
        F.col("_top.positions").alias("peak_positions"), "overloaded_count",
    )


def hourly_totals(load: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return load.groupBy(*by, "hour").agg(F.sum("positions").alias("positions")).orderBy(*by, "hour")


def load_matrix(load: DataFrame) -> DataFrame:
    """Presentation form: one row per sector, one column per hour."""
    return load.groupBy("sector").pivot("hour", list(range(24))).agg(F.first("positions"))


def peak_sector_hours(matrix: DataFrame, top_n: int = 5) -> DataFrame:
    """Unpivots the matrix and ranks its cells."""
    hours = [c for c in matrix.columns if c != "sector"]
    return (
        matrix.unpivot("sector", hours, "hour", "count")
        .withColumn("hour", F.col("hour").cast("int"))
        .orderBy(F.desc("count"), "hour", "sector")
        .limit(top_n)
    )


def load_maps(load: DataFrame) -> DataFrame:
    """One row: sector -> hour -> count, as nested maps (20 x 24 entries)."""
    hours = load.groupBy("sector").agg(
        F.map_from_entries(F.collect_list(F.struct("hour", "positions"))).alias("hours")
    )
    return hours.agg(
        F.map_from_entries(F.collect_list(F.struct("sector", "hours"))).alias("sector_loads")
    )
