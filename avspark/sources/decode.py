"""Decoding landed JSON: position vectors and hourly forecasts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark import schemas
from avspark.functions import positions

# Values used when a forecast has no entry for the hour (fixed values).
FORECAST_DEFAULTS = {
    "temperature_2m": 15.0,
    "wind_speed_10m": 5.0,
    "precipitation": 0.0,
    "visibility": 10000.0,
    "cloud_cover": 20.0,
    "weather_code": 0,
}


def decode_states(responses: DataFrame, column: str = "response") -> DataFrame:
    """One typed row per position vector that has coordinates.

    Other columns of ``responses`` are kept. Slots: 0 address, 1 callsign, 2 country,
    5 longitude, 6 latitude, 7 barometric altitude, 8 on ground, 9 velocity, 10 track,
    13 geometric altitude. A value that is no number counts as missing.
    """
    kept = [c for c in responses.columns if c != column]
    vectors = (
        responses.withColumn("_r", F.from_json(column, schemas.RAW_STATES))
        .select(*kept, F.col("_r.time").alias("fetched_at"), F.explode("_r.states").alias("s"))
    )
    return vectors.where(_number(5).isNotNull() & _number(6).isNotNull()).select(*kept, "fetched_at", *_state())


def _slot(i: int) -> Column:
    return F.get("s", F.lit(i))


def _number(i: int) -> Column:
    return _slot(i).try_cast("double")


def _state() -> list[Column]:
    """The typed fields of a vector ``s``."""
    text = lambda i: F.coalesce(_slot(i), F.lit(""))
    return [
        text(0).alias("icao24"), F.trim(text(1)).alias("callsign"), text(2).alias("origin_country"),
        _number(5).alias("longitude"), _number(6).alias("latitude"),
        positions.best_altitude(_number(13), _number(7)).alias("altitude_m"),
        F.coalesce(_number(9), F.lit(0.0)).alias("velocity_mps"),
        F.coalesce(_number(10), F.lit(0.0)).alias("heading_deg"),
        F.coalesce(_slot(8).try_cast("boolean"), F.lit(False)).alias("on_ground"),
    ]


def classified_states(responses: DataFrame, column: str = "response") -> DataFrame:
    """Every position vector of every response: its typed fields, ``accepted``, and why not.

    ``vector`` is its place in the response. Accepted are the rows of :func:`decode_states`. Reasons:
    ``bad_response`` (no list of states could be read) and ``no_states`` (an empty list) for a response, with
    one row and no place; ``missing_position`` and ``bad_number`` for a vector without a usable
    longitude and latitude. ``raw`` keeps what was rejected, as text.
    """
    kept = [c for c in responses.columns if c != column]
    vectors = responses.withColumn("_r", F.from_json(column, schemas.RAW_STATES)).select(
        *kept, F.col(column).alias("_text"), F.col("_r.time").alias("fetched_at"), F.col("_r.states").isNull().alias("_bad"),
        F.posexplode_outer("_r.states").alias("vector", "s"))
    reason = (
        F.when(F.col("_bad"), "bad_response").when(F.col("vector").isNull(), "no_states")
        .when(_slot(5).isNull() | _slot(6).isNull(), "missing_position")
        .when(_number(5).isNull() | _number(6).isNull(), "bad_number"))
    return vectors.withColumn("reason", reason).select(
        *kept, "fetched_at", "vector", F.col("reason").isNull().alias("accepted"), "reason",
        F.when(F.col("vector").isNull(), F.col("_text")).when(F.col("reason").isNotNull(), F.coalesce(F.to_json("s"), F.lit("null"))).alias("raw"),
        *_state())


def write_with_quarantine(responses: DataFrame, path: str, column: str = "response") -> None:
    """Writes accepted vectors and rejected ones in one pass over ``responses``, each to its own part of
    ``path``. Writing again replaces both: a stream gives each batch a path of its own, so that a
    replay counts nothing twice."""
    classified_states(responses, column).write.mode("overwrite").partitionBy("accepted").parquet(path)


def _classified(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)   # the folder's name makes ``accepted`` a string
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        empty = classified_states(spark.createDataFrame([], "response string"))   # written from no vectors
        return empty.withColumn("accepted", F.col("accepted").cast("string"))


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return _classified(spark, path).where("accepted = 'true'").drop("accepted", "reason", "raw")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """What was rejected, why, and its text."""
    fields = [f.name for f in schemas.AIRCRAFT_STATE.fields]
    return _classified(spark, path).where("accepted = 'false'").drop("accepted", *fields)


def _forecast(payloads: DataFrame, column: str) -> DataFrame:
    return payloads.withColumn("_h", F.from_json(column, schemas.HOURLY_FORECAST)["hourly"]).drop(column)


def _record(get) -> list[Column]:
    """The six live-weather fields; ``get(name)`` yields a raw value or null."""
    def value(name: str) -> Column:
        return F.coalesce(get(name), F.lit(FORECAST_DEFAULTS[name]))

    return [
        value("temperature_2m").alias("temperature_c"),
        value("wind_speed_10m").alias("wind_speed_knots"),
        value("precipitation").alias("precipitation_mm_hr"),
        positions.kilometres(value("visibility")).alias("visibility_km"),
        value("cloud_cover").alias("cloud_cover_pct"),
        value("weather_code").cast("int").alias("weather_code"),
    ]


def first_hour(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Current conditions: element 0 of each hourly array, with defaults."""
    df = _forecast(payloads, column)
    kept = [c for c in df.columns if c != "_h"]
    return df.select(*kept, *_record(lambda name: F.get(F.col("_h")[name], F.lit(0))))


def hourly_series(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row per forecast hour."""
    df = _forecast(payloads, column)
    kept = [c for c in df.columns if c != "_h"]
    names = ["time", *FORECAST_DEFAULTS]
    zipped = F.arrays_zip(*[
        F.coalesce(F.col("_h")[n], F.array().cast(
            "array<string>" if n == "time" else "array<int>" if n == "weather_code" else "array<double>"
        )).alias(n) for n in names
    ])
    rows = df.withColumn("_z", zipped).select(*kept, F.posexplode("_z").alias("step", "_e"))
    return rows.select(
        *kept, "step", F.col("_e")["time"].alias("time"), *_record(lambda n: F.col("_e")[n])
    )
