"""Derives the airline tables from the given star schema and event feed.

Flights come from ``lineitem``; ``orders``, ``customer`` and ``supplier`` are unique-key
lookups that add date, destination and origin. Only the lookups that a query's columns
need are joined, so a carrier report is a single scan. Every formula is integer
arithmetic where possible, so any engine gets the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark import dims, schemas
from avspark.functions import flights as ff
from avspark.functions import geo, positions
from avspark.functions.numeric import round_dp
from avspark.session import pin_utc

PERF_COLUMNS = (
    "flight_id", "year", "month", "day_of_month", "day_of_week", "dep_hour", "carrier",
    "origin", "destination", "distance_mi", "delay_minutes", "is_delayed", "delay_cause",
)
OPS_COLUMNS = (
    "flight_id", "airline", "flight_number", "aircraft_type", "origin", "destination",
    "distance_mi", "scheduled_departure", "scheduled_arrival", "actual_departure",
    "actual_arrival", "delay_minutes", "delay_cause", "is_delayed", "dep_hour",
    "day_of_week", "month",
)

_FROM_ORDERS = {"year", "month", "day_of_month", "day_of_week", "order_date"}


def _cents() -> Column:
    return F.rint(F.col("l_extendedprice") * 100).cast("bigint")


def _delay_tenths() -> Column:
    return (
        F.when(F.col("l_returnflag") == "R", _cents() % 3001)
        .when(F.col("l_returnflag") == "A", _cents() % 601)
        .otherwise(F.lit(0).cast("bigint"))
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def airport_distances(spark: SparkSession) -> DataFrame:
    """(pair_id, distance_mi) for the network: 600 rows, fixed.

    pair_id is origin ordinal * 25 + destination ordinal.
    """
    codes = dims.constants(dims.NETWORK_CODES)
    origin = F.array_position(codes, F.col("origin")) - 1
    destination = F.array_position(codes, F.col("destination")) - 1
    return dims.airport_pairs(spark).select(
        (origin * 25 + destination).alias("pair_id"),
        round_dp(geo.haversine_mi(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")), 1)
        .alias("distance_mi"),
    )


def _flight_base(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    need_dest = bool(wanted & {"destination", "distance_mi"})
    if need_dest or wanted & _FROM_ORDERS:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if need_dest:
            # Orders meet their customers first, so that the many line items move for one join, not two.
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    if need_dest or "origin" in wanted:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left")
        df = df.withColumn("origin", dims.pick(dims.NETWORK_CODES, F.col("s_nationkey")))
    if not need_dest:
        return df
    detour = (F.col("c_nationkey") + 1 + F.col("l_partkey") % 24) % 25
    to = F.when(F.col("c_nationkey") == F.col("s_nationkey"), detour).otherwise(F.col("c_nationkey"))
    df = df.withColumn("destination", dims.pick(dims.NETWORK_CODES, to))
    if "distance_mi" in wanted:
        # 600 fixed rows under one integer key: the broadcast cannot grow with the data.
        df = df.withColumn("pair_id", F.col("s_nationkey").cast("bigint") * 25 + to)
        df = df.join(F.broadcast(airport_distances(spark)), "pair_id", "left")
    return df


def _shared_columns() -> dict[str, Column]:
    date = F.col("o_orderdate")
    delay = _delay_tenths() / 10
    return {
        "flight_id": F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            _cents().cast("string"), F.expr("CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS STRING)"),
        ),
        "year": F.year(date), "month": F.month(date), "day_of_month": F.dayofmonth(date),
        "day_of_week": F.weekday(date),
        "dep_hour": (F.col("l_partkey") % 24).cast("int"),
        "carrier": dims.pick(dims.CARRIERS, F.col("l_suppkey") % 10),
        "origin": F.col("origin"), "destination": F.col("destination"),
        "distance_mi": F.col("distance_mi"),
        "delay_minutes": delay,
        "is_delayed": ff.is_delayed(delay).cast("int"),
        "delay_cause": ff.cause_or_none(delay, dims.pick(dims.DELAY_CAUSES, F.col("l_partkey") % 5)),
    }


def perf_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Carrier-performance flights, with only the columns asked for (default all)."""
    names = columns or PERF_COLUMNS
    base = _flight_base(spark, sf_dir, set(names))
    exprs = _shared_columns()
    return base.select(*[exprs[c].alias(c) for c in names])


def ops_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Operations flights in a 30-day window, with only the columns asked for."""
    names = columns or OPS_COLUMNS
    wanted = set(names)
    timed = {"scheduled_departure", "scheduled_arrival", "actual_departure", "actual_arrival",
             "day_of_week", "month"}
    needs = set(wanted)
    if wanted & timed:
        needs.add("order_date")
    needs -= {"day_of_week", "month"}
    if wanted & {"scheduled_arrival", "actual_arrival"}:
        needs.add("distance_mi")
    base = _flight_base(spark, sf_dir, needs)

    exprs = _shared_columns()
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    day = (F.datediff(F.col("o_orderdate"), F.to_date(F.lit("1995-01-01"))) % 30).cast("int")
    departure = start + F.make_dt_interval(
        day, exprs["dep_hour"], (F.col("l_linenumber") % 4 * 15).cast("int")
    )
    arrival = ff.add_minutes(departure, ff.flight_minutes(F.col("distance_mi")))
    delay = exprs["delay_minutes"]
    airline = dims.pick(dims.AIRLINES, F.col("l_suppkey") % 8)
    exprs.update({
        "airline": airline,
        "flight_number": F.concat(airline, (F.col("l_partkey") % 9899 + 100).cast("string")),
        "aircraft_type": dims.pick(dims.AIRCRAFT_TYPES, F.col("l_partkey") % 4),
        "scheduled_departure": departure,
        "scheduled_arrival": arrival,
        "actual_departure": ff.add_minutes(departure, delay),
        "actual_arrival": ff.add_minutes(arrival, delay + F.col("l_partkey") % 10),
        "day_of_week": F.weekday(departure),
        "month": F.month(departure),
    })
    return base.select(*[exprs[c].alias(c) for c in names])


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _value_cents() -> Column:
    return F.rint(F.col("value") * 100).cast("bigint")


def weather_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly reports, one per airport and hour that has any event."""
    from avspark.functions import weather as fw

    airport = dims.pick(dims.NETWORK_CODES, F.col("user_id") % 25)
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(airport.alias("airport"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
        .agg(
            F.min(_value_cents() % 96 + 5).alias("vis_tenths"),
            F.min(_k()).alias("k"),
            F.max(F.col("event_id") * 37 % 500).alias("wind_tenths"),
            F.max(F.col("event_id") * 13 % 360).alias("wind_dir"),
        )
    )
    vis, wind = F.col("vis_tenths") / 10, F.col("wind_tenths") / 10
    ceiling = (F.col("k") * 100 + 200).cast("int")
    return hourly.select(
        "airport", "ts", F.hour("ts").alias("hour"),
        wind.alias("wind_speed_kts"), F.col("wind_dir").cast("double").alias("wind_dir_deg"),
        vis.alias("visibility_sm"), ceiling.alias("ceiling_ft"),
        fw.conditions(vis, ceiling).alias("conditions"),
        fw.impact_score(vis, ceiling, wind).alias("weather_impact_score"),
    )


def live_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live weather records per airport, as they arrive."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts",
        dims.pick(dims.NETWORK_CODES, F.col("user_id") % 25).alias("airport"),
        (F.col("event_id") * 7 % 400 / 10 - 5).alias("temperature_c"),
        (F.col("event_id") * 37 % 500 / 10).alias("wind_speed_knots"),
        (_k() % 20 / 10).alias("precipitation_mm_hr"),
        (_value_cents() % 200 / 10).alias("visibility_km"),
        _k().cast("double").alias("cloud_cover_pct"),
        dims.pick((0, 3, 61, 80, 95, 99), F.col("event_id") % 6).alias("weather_code"),
    )


def positions_from_events(events: DataFrame) -> DataFrame:
    """Aircraft positions of an event feed, batch or stream (stateless)."""
    baro = (_value_cents() * 7 % 12193).cast("double")
    geometric = (
        F.when(_k() % 10 == 0, F.lit(None).cast("double"))
        .when(_k() % 10 == 1, F.lit(0.0))
        .otherwise(((_value_cents() * 7 + 50) % 12193).cast("double"))
    )
    typed = events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.lpad(F.lower(F.hex("user_id")), 6, "0").alias("icao24"),
        F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(
            F.concat(F.upper(F.substring("event_type", 1, 3)), F.col("user_id").cast("string"))
        ).alias("callsign"),
        dims.pick(("United States", "Canada", "Mexico"), F.col("event_id") % 3).alias("origin_country"),
        (F.col("event_id") * 104729 % 6500 / 100 - 127).alias("longitude"),
        F.when(F.col("event_id") % 97 != 0, F.col("event_id") * 7919 % 2900 / 100 + 23).alias("latitude"),
        baro.alias("baro_altitude"), geometric.alias("geo_altitude"),
        positions.best_altitude(geometric, baro).alias("altitude_m"),
        (_k() * 21 / 10 + 60).alias("velocity_mps"),
        (F.col("event_id") * 13 % 360).cast("double").alias("heading_deg"),
    )
    return typed.withColumn("on_ground", F.col("altitude_m") < 30)


def aircraft_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_from_events(table(spark, sf_dir, "events")).drop(
        "baro_altitude", "geo_altitude"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests as users send them: one per flight, many of them malformed."""
    df = _flight_base(spark, sf_dir, {"origin", "destination", "distance_mi"})
    exprs = _shared_columns()
    p = F.col("l_partkey")

    def variants(modulus: int, default, *cases) -> Column:
        out = F.when(p % modulus == 0, cases[0])
        for i, case in enumerate(cases[1:], 1):
            out = out.when(p % modulus == i, case)
        return out.otherwise(default)

    origin, dest = F.col("origin"), F.col("destination")
    iso = F.concat(
        F.lit("2024-01-"), F.lpad((p % 28 + 1).cast("string"), 2, "0"), F.lit("T"),
        F.lpad((p % 24).cast("string"), 2, "0"), F.lit(":30:00"),
    )
    airline = dims.pick(dims.AIRLINES, F.col("l_suppkey") % 8)
    aircraft = dims.pick(dims.AIRCRAFT_TYPES, p % 4)
    return df.select(
        exprs["flight_id"].alias("request_id"),
        variants(11, origin, F.lower(origin), F.concat(F.lit(" "), origin, F.lit(" ")),
                 F.substring(origin, 1, 2), F.lit("ZZZ")).alias("origin"),
        variants(13, dest, F.lower(dest), F.lit("ZZZ"),
                 F.concat(F.lit("4"), F.substring(dest, 2, 2))).alias("destination"),
        variants(17, iso, F.replace(iso, F.lit("T"), F.lit(" ")), F.lit("2024-02-30T08:00:00"),
                 F.concat(F.lit(" "), iso, F.lit(" "))).alias("scheduled_departure"),
        variants(7, airline, F.lower(airline), F.lit("XX")).alias("airline"),
        variants(19, aircraft, F.lit("Concorde"), F.lower(aircraft)).alias("aircraft_type"),
        F.when(p % 23 == 0, 24).otherwise(p % 24).cast("int").alias("dep_hour"),
        F.when(p % 29 == 0, 7).otherwise(p % 7).cast("int").alias("day_of_week"),
        variants(31, F.col("distance_mi"), F.lit(0.5), F.lit(None).cast("double"), F.lit(20000.0))
        .alias("distance_mi"),
        (p % 260).cast("int").alias("row_limit"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions, one to three per flight, some for flights that are gone."""
    df = table(spark, sf_dir, "lineitem")
    flight_id = _shared_columns()["flight_id"]
    return df.select(
        F.when(F.col("l_partkey") % 37 == 0, F.concat(F.lit("X-"), flight_id)).otherwise(flight_id)
        .alias("flight_id"),
        (F.col("l_partkey") % 100 / 100).alias("delay_probability"),
        F.explode(F.sequence(F.lit(0), (F.col("l_linenumber") % 3).cast("int"))).alias("version"),
    )


def raw_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polling responses as JSON text: 17-slot vectors, the second without coordinates."""
    s = positions_from_events(table(spark, sf_dir, "events"))

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))

    def vector(longitude: Column) -> Column:
        quote = F.lit('"')
        slots = [
            F.concat(quote, F.col("icao24"), quote),
            F.concat(quote, F.col("callsign"), F.lit('  "')),
            F.concat(quote, F.col("origin_country"), quote),
            F.lit("1"), F.lit("2"), longitude, number("latitude"), number("baro_altitude"),
            number("on_ground"), number("velocity_mps"), number("heading_deg"),
            F.lit("null"), F.lit("null"), number("geo_altitude"),
            F.lit("null"), F.lit("false"), F.lit("0"),
        ]
        return F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]"))

    response = F.concat(
        F.lit('{"time":'), F.unix_seconds("ts").cast("string"), F.lit(',"states":['),
        vector(number("longitude")), F.lit(","), vector(F.lit("null")), F.lit("]}"),
    )
    return s.select("event_id", response.alias("response"))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly forecast payloads as JSON text: 1 to 3 hours, parts missing or empty."""
    e = F.col("event_id")

    def series(base: Column) -> Column:
        hours = F.sequence(F.lit(0), (e % 3).cast("int"))
        return F.concat(F.lit("["), F.concat_ws(",", F.transform(
            hours, lambda i: (base + i).cast("string"))), F.lit("]"))

    parts = [
        F.concat(F.lit('"temperature_2m":'), series(e % 30)),
        F.when(e % 5 != 0, F.concat(F.lit('"wind_speed_10m":'), series(e % 50))),
        F.when(e % 7 == 0, F.lit('"precipitation":[]')).otherwise(
            F.concat(F.lit('"precipitation":'), series(e % 4))),
        F.when(e % 11 != 0, F.concat(F.lit('"visibility":'), series(e * 13 % 20000))),
        F.concat(F.lit('"cloud_cover":'), series(e % 99)),
        F.when(e % 3 != 0, F.concat(F.lit('"weather_code":'), series(e % 97))),
    ]
    payload = F.concat(F.lit('{"hourly":{'), F.concat_ws(",", *parts), F.lit("}}"))
    return table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
