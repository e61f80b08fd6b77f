"""Airport weather: as-of joins, summaries.

Reports are first reduced to one row per airport and hour, however many raw reports an
airport sent; as-of joins then carry the last one from month to month and within each month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import weather as fw
from avspark.functions.numeric import round_dp


def _hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hourly_reports(reports: DataFrame, *values: str) -> DataFrame:
    """The last report of each airport and hour; ``ts`` becomes the hour.

    Only the named columns are kept. A single numeric one is reduced by hash aggregation;
    several travel as one struct so that a row's values stay together. Of reports of the same
    instant the one with the largest values counts, whatever the partitioning.
    """
    one = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    newest = reports.groupBy("airport", _hour_of(F.col("ts")).alias("_hour")).agg(
        F.max_by(one, F.struct("ts", *values)).alias("_v")
    )
    out = [F.col("_v").alias(values[0])] if len(values) == 1 else [F.col("_v.*")]
    return newest.select("airport", F.col("_hour").alias("ts"), *out)


def _in_force(asked: DataFrame, hourly: DataFrame) -> DataFrame:
    """(airport, _at, _v): for each airport and hour of ``asked``, the values of its last report so far, or
    else of its first one.

    Works in two levels. Months are summed up to their last report, and that is carried from month to
    month; hours asked for and hours reported then meet within a month. There is no row for an hour that
    is neither, so gaps of years cost nothing; a window holds the months of an airport or the hours of a month.
    """
    month = F.date_trunc("month", F.col("_at")).alias("_month")
    values = [c for c in hourly.columns if c not in ("airport", "ts")]
    reported = hourly.select("airport", F.col("ts").alias("_at"), F.struct(*values).alias("_v"), F.lit(False).alias("_asked"))
    rows = reported.unionByName(asked.select("airport", "_at", F.lit(True).alias("_asked")), allowMissingColumns=True)
    rows = rows.groupBy("airport", month, "_at").agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_at"))).alias("_v"), F.max("_asked").alias("_asked"))

    report_time = F.when(F.col("_v").isNotNull(), F.col("_at"))
    months = rows.groupBy("airport", "_month").agg(
        F.max_by("_v", report_time).alias("_last"), F.min_by("_v", report_time).alias("_first"))
    by_month = Window.partitionBy("airport").orderBy("_month")
    before = F.last("_last", ignorenulls=True).over(by_month.rowsBetween(Window.unboundedPreceding, -1))
    first = F.first("_first", ignorenulls=True).over(by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    carried = months.select("airport", "_month", F.coalesce(before, first).alias("_carried"))

    within = F.last("_v", ignorenulls=True).over(
        Window.partitionBy("airport", "_month").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("_v", within).where("_asked").join(carried, ["airport", "_month"])
        .select("airport", "_at", F.coalesce("_v", "_carried").alias("_v")))


def as_of_ends(
    keys: DataFrame, reports: DataFrame, airports: DataFrame, *, ts: str, ends: dict[str, dict[str, str]],
) -> DataFrame:
    """Adds the reports in force at ``ts`` at each of several airports of a row.

    ``ends`` maps an airport column to {report column: output name}. A report is in force from its hour
    on until the next one. Times before an airport's first report take the first. Unknown airports,
    airports without reports and null times give nulls.

    All ends share one lookup, which has a row for each airport and hour that occurs in ``keys``. The
    keys are combined before they are shuffled for it, so a hot airport is as cheap as others. AQE
    picks a broadcast or a skew-split shuffle for the equi joins from measured sizes.
    """
    known = airports.select(F.col("code").alias("airport"))
    values = list(dict.fromkeys(c for names in ends.values() for c in names))
    hourly = hourly_reports(reports, *values).join(F.broadcast(known), "airport", "left_semi")
    keys = keys.withColumn("_at", _hour_of(F.col(ts)))
    asked = (
        keys.where(F.col("_at").isNotNull())
        .select("_at", F.explode(F.array_distinct(F.array(*ends))).alias("airport")).distinct()
        .join(F.broadcast(known), "airport", "left_semi"))
    lookup = _in_force(asked, hourly)
    for airport, names in ends.items():
        side = lookup.select(F.col("airport").alias(airport), "_at", *[F.col(f"_v.{c}").alias(n) for c, n in names.items()])
        keys = keys.join(side, [airport, "_at"], "left")
    return keys.drop("_at")


def as_of(
    keys: DataFrame, reports: DataFrame, airports: DataFrame, *,
    airport: str, ts: str, values: dict[str, str],
) -> DataFrame:
    """:func:`as_of_ends` for one airport column; ``values`` maps report columns to output names."""
    return as_of_ends(keys, reports, airports, ts=ts, ends={airport: values})


def flight_weather(flights: DataFrame, reports: DataFrame, airports: DataFrame) -> DataFrame:
    """Impact and conditions at both ends of each flight, as of departure."""
    return as_of_ends(flights, reports, airports, ts="scheduled_departure", ends={
        role: {"weather_impact_score": f"{role}_impact", "conditions": f"{role}_conditions"}
        for role in ("origin", "destination")})


CONDITION_COLUMNS = (
    "conditions", "visibility_sm", "ceiling_ft", "wind_speed_kts", "weather_impact_score",
)


def conditions_at(
    reports: DataFrame, airports: DataFrame, at: str, columns=CONDITION_COLUMNS
) -> DataFrame:
    """Report in force at one time for every airport that has reports."""
    keys = airports.select(
        F.col("code").alias("airport"), "city", F.expr(f"timestamp_ntz'{at}'").alias("reference_time")
    )
    return as_of(
        keys, reports, airports, airport="airport", ts="reference_time",
        values={c: c for c in columns},
    ).where(F.col("weather_impact_score").isNotNull())


def pinned_impacts(reports: DataFrame, airports: DataFrame, day: str = "2024-01-15") -> DataFrame:
    """(airport, hour, impact) for each hour of one reference day: 24 rows an airport."""
    keys = airports.select(
        F.col("code").alias("airport"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    ).withColumn("reference_time", F.expr(f"timestamp_ntz'{day} 00:00:00'") + F.make_dt_interval(hours=F.col("hour")))
    return as_of(
        keys, reports, airports, airport="airport", ts="reference_time",
        values={"weather_impact_score": "impact"},
    ).drop("reference_time")


def hourly_impact(reports: DataFrame, airports: DataFrame) -> DataFrame:
    """Mean impact per airport and hour of day, dense, zero where nothing was reported."""
    thousandths = F.sum(F.rint(F.col("weather_impact_score") * 1000).cast("bigint"))
    means = reports.groupBy("airport", "hour").agg(
        round_dp(thousandths.cast("double") / (F.count(F.lit(1)) * F.lit(1000.0)), 4).alias("mean_impact")
    )
    grid = airports.select(
        F.col("code").alias("airport"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    )
    return grid.join(means, ["airport", "hour"], "left").na.fill(0.0, ["mean_impact"])


def halos(reports: DataFrame, airports: DataFrame) -> DataFrame:
    """Warning circles for reports below visual conditions."""
    lookup = airports.select(F.col("code").alias("airport"), "lat", "lon")
    return (
        reports.where(F.col("conditions") != "VMC")
        .join(F.broadcast(lookup), "airport")
        .select(
            "airport", "ts", "lat", "lon", "conditions",
            fw.marker_colour(F.col("conditions")).alias("marker"),
            round_dp(fw.halo_radius_m(F.col("weather_impact_score")), 1).alias("radius_m"),
        )
    )


_LIVE_FIELDS = (
    "temperature_c", "wind_speed_knots", "precipitation_mm_hr", "visibility_km",
    "cloud_cover_pct", "weather_code",
)


def with_risk(live: DataFrame) -> DataFrame:
    inputs = ("wind_speed_knots", "visibility_km", "precipitation_mm_hr", "cloud_cover_pct", "weather_code")
    return live.withColumn("risk_score", fw.risk_score(*[F.col(c) for c in inputs]))


def newest_records(live: DataFrame, airports: DataFrame) -> DataFrame:
    """The newest record of each known airport, with the columns of ``live``: as many rows as airports at most."""
    newest = live.groupBy("airport").agg(F.max_by(F.struct(*live.columns), F.struct("ts", "event_id")).alias("_r"))
    known = newest.join(F.broadcast(airports.select(F.col("code").alias("airport"))), "airport", "left_semi")
    return known.select("_r.*")


def latest_live(live: DataFrame, airports: DataFrame) -> DataFrame:
    """Newest record of each known airport as a struct, with its risk."""
    newest = live.groupBy("airport").agg(
        F.max_by(F.struct(*_LIVE_FIELDS), F.struct("ts", "event_id")).alias("weather")
    ).join(F.broadcast(airports.select(F.col("code").alias("airport"))), "airport", "left_semi")
    risk = with_risk(newest.select("airport", "weather", "weather.*"))
    return risk.select("airport", "weather", "risk_score")


def route_weather(
    routes: DataFrame, live: DataFrame, airports: DataFrame, default_risk: float | None = None
) -> DataFrame:
    """Both end points' newest weather and the larger of their risks.

    Routes with an end that has no record are dropped, or kept with ``default_risk`` for that
    end if it is given. The newest-weather table has one row per known airport, so it is
    broadcast.
    """
    newest = latest_live(live, airports)
    for role in ("origin", "destination"):
        side = newest.select(
            F.col("airport").alias(role), F.col("weather").alias(f"{role}_weather"),
            F.col("risk_score").alias(f"{role}_risk"),
        )
        routes = routes.join(F.broadcast(side), role, "inner" if default_risk is None else "left")
        if default_risk is not None:
            routes = routes.na.fill(default_risk, [f"{role}_risk"])
    return routes.withColumn("max_risk_score", F.greatest("origin_risk", "destination_risk"))


def network(spark) -> DataFrame:
    return dims.airports(spark, dims.NETWORK)
