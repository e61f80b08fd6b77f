"""Request validation and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avspark import dims

# Accepted forms (fixed values).
IATA_PATTERN = "^[A-Z]{3}$"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
_ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def parsed_time(text: Column) -> Column:
    """The timestamp of a well-formed ISO text, else null."""
    return F.when(
        text.rlike(ISO_PATTERN), F.try_to_timestamp(text, F.lit(_ISO_FORMAT)).cast("timestamp_ntz")
    )


def validate_requests(requests: DataFrame) -> DataFrame:
    """Normalised request fields plus ``errors``, the list of failed rules.

    Expects: request_id, origin, destination, scheduled_departure (text), airline,
    aircraft_type, dep_hour, day_of_week, distance_mi (may be null), row_limit.
    """
    code = {c: F.upper(F.trim(c)) for c in ("origin", "destination", "airline")}
    stamp = F.trim("scheduled_departure")
    rules: list[tuple[str, Column]] = []
    for role in ("origin", "destination"):
        well_formed = code[role].rlike(IATA_PATTERN)
        rules.append((f"{role}_format", ~well_formed))
        rules.append((f"{role}_unknown", well_formed & ~code[role].isin(*dims.ALL_CODES)))
    rules += [
        ("departure_format", ~stamp.rlike(ISO_PATTERN)),
        ("departure_value", stamp.rlike(ISO_PATTERN) & parsed_time(stamp).isNull()),
        ("airline", ~code["airline"].isin(*dims.AIRLINES)),
        ("aircraft_type", ~F.col("aircraft_type").isin(*dims.AIRCRAFT_TYPES)),
        ("dep_hour", ~F.col("dep_hour").between(0, 23)),
        ("day_of_week", ~F.col("day_of_week").between(0, 6)),
        ("distance_mi", ~F.coalesce(F.col("distance_mi").between(1.0, 15000.0), F.lit(True))),
        ("row_limit", ~F.col("row_limit").between(1, 200)),
    ]
    # A missing required field fails its rule.
    errors = F.filter(
        F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules]),
        lambda e: e.isNotNull(),
    )
    return requests.select(
        "request_id", code["origin"].alias("origin"), code["destination"].alias("destination"),
        code["airline"].alias("airline"), "aircraft_type", stamp.alias("scheduled_departure"),
        "dep_hour", "day_of_week", "distance_mi", "row_limit", errors.alias("errors"),
    )


def split_parsable(requests: DataFrame, airports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows with times and coordinates, rejected rows). Nothing is lost."""
    from avspark.operators.lookups import with_route_airports

    timed = requests.withColumn("departure", parsed_time(F.col("scheduled_departure")))
    good = with_route_airports(timed.where(F.col("departure").isNotNull()), airports)
    # Airport codes are a constant list, so rejection needs no second join.
    codes = list(dims.ALL_CODES)
    known = F.coalesce(F.col("origin").isin(codes) & F.col("destination").isin(codes), F.lit(False))
    bad = timed.where(F.col("departure").isNull() | ~known)
    return good, bad


def key_checks(flights: DataFrame, predictions: DataFrame, not_null: list[str]) -> DataFrame:
    """One row per rule with its number of violations.

    All rules come from one scan of each table and one grouping by flight id, combined before the
    shuffle. Null ids are one id that no prediction finds.
    """
    nulls = [F.col(c).isNull().cast("bigint").alias(f"_null_{i}") for i, c in enumerate(not_null)]
    none = [F.lit(0).cast("bigint").alias(f"_null_{i}") for i in range(len(not_null))]
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = flights.select("flight_id", one.alias("_f"), zero.alias("_p"), *nulls).unionByName(
        predictions.select("flight_id", zero.alias("_f"), one.alias("_p"), *none))
    counts = ["_f", "_p", *[f"_null_{i}" for i in range(len(not_null))]]
    by_id = rows.groupBy("flight_id").agg(*[F.sum(c).alias(c) for c in counts])
    orphan = (F.col("_f") == 0) | F.col("flight_id").isNull()
    rules = {
        "flight_id_unique": F.count_if(F.col("_f") > 1),
        **{f"{c}_not_null": F.sum(f"_null_{i}") for i, c in enumerate(not_null)},
        "prediction_flight_exists": F.sum(F.when(orphan, F.col("_p"))),
    }
    found = by_id.agg(*[F.coalesce(v, zero).alias(rule) for rule, v in rules.items()])
    return found.unpivot([], list(rules), "rule", "violations")
