"""Physical schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

PERF_FLIGHTS = T.StructType([
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ByteType()),
    T.StructField("day_of_month", T.ByteType()),
    T.StructField("day_of_week", T.ByteType()),
    T.StructField("dep_hour", T.ByteType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("distance_mi", T.FloatType()),
    T.StructField("delay_minutes", T.FloatType()),
    T.StructField("is_delayed", T.ByteType()),
    T.StructField("delay_cause", T.StringType()),
])

OPS_FLIGHTS = T.StructType([
    T.StructField("flight_id", T.StringType(), False),
    T.StructField("airline", T.StringType(), False),
    T.StructField("flight_number", T.StringType(), False),
    T.StructField("aircraft_type", T.StringType(), False),
    T.StructField("origin", T.StringType(), False),
    T.StructField("destination", T.StringType(), False),
    T.StructField("distance_mi", T.DoubleType(), False),
    T.StructField("scheduled_departure", T.TimestampNTZType(), False),
    T.StructField("scheduled_arrival", T.TimestampNTZType(), False),
    T.StructField("actual_departure", T.TimestampNTZType()),
    T.StructField("actual_arrival", T.TimestampNTZType()),
    T.StructField("delay_minutes", T.DoubleType()),
    T.StructField("delay_cause", T.StringType()),
    T.StructField("is_delayed", T.IntegerType()),
    T.StructField("dep_hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

AIRCRAFT_STATE = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("altitude_m", T.DoubleType()),
    T.StructField("velocity_mps", T.DoubleType()),
    T.StructField("heading_deg", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
])

# One polling response: epoch seconds and 17-slot position vectors.
RAW_STATES = "time bigint, states array<array<string>>"

# One forecast response: equal-length hourly arrays.
HOURLY_FORECAST = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "wind_speed_10m: array<double>, precipitation: array<double>, "
    "visibility: array<double>, cloud_cover: array<double>, weather_code: array<int>>"
)

SNAPSHOT_LOG = T.StructType([
    T.StructField("fetched_at", T.LongType(), False),
    T.StructField("payload", T.StringType(), False),
])

# The given tables. Declaring them saves a footer-reading job for each table and query.
TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}
