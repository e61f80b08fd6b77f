"""Carrier, route and time-of-day delay performance.

Every report is grouped aggregation with map-side partial results: what crosses the
network is one row per group and task, so a carrier or route holding a third of all
flights costs no more than any other. Delay sums are taken in whole tenths of a minute,
which makes averages independent of partitioning.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avspark import dims
from avspark.functions import flights as ff
from avspark.functions.numeric import mean_of_tenths, round_dp, share, tenths


def _delay() -> Column:
    return tenths(F.col("delay_minutes"))


def _n() -> Column:
    return F.count(F.lit(1))


def _delayed() -> Column:
    return F.sum(F.col("is_delayed").cast("bigint"))


def _avg(places: int) -> Column:
    return mean_of_tenths(F.sum(_delay()), _n(), places)


def on_time_by_carrier(flights: DataFrame) -> DataFrame:
    """Totals, on-time share, mean and exact median delay per carrier, best first.

    The median comes from a (carrier, delay) histogram. Its size depends on the number
    of distinct delays, not on the number of flights, so no group is ever gathered.
    """
    histogram = flights.groupBy("carrier", _delay().alias("t")).agg(
        _n().alias("n"), _delayed().alias("delayed")
    )
    n = F.sum("n")
    return (
        histogram.groupBy("carrier")
        .agg(
            n.alias("total_flights"),
            F.sum("delayed").alias("delayed_flights"),
            share(n - F.sum("delayed"), n, 4).alias("on_time_pct"),
            mean_of_tenths(F.sum(F.col("t") * F.col("n")), n, 2).alias("avg_delay_minutes"),
            round_dp(F.percentile("t", F.lit(0.5), F.col("n")) / 10.0, 2).alias("median_delay"),
        )
        .orderBy(F.desc("on_time_pct"), "carrier")
    )


def delay_by_route(flights: DataFrame, top_n: int = 30) -> DataFrame:
    """Routes with the highest mean delay; names break ties."""
    return (
        flights.groupBy("origin", "destination")
        .agg(_avg(2).alias("avg_delay"), _n().alias("total_flights"))
        .withColumn("route", ff.route_label(F.col("origin"), F.col("destination")))
        .select("route", "origin", "destination", "avg_delay", "total_flights")
        .orderBy(F.desc("avg_delay"), "origin", "destination")
        .limit(top_n)
    )


def monthly_trends(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("year", "month")
        .agg(
            _n().alias("total_flights"),
            share(_delayed(), _n(), 4).alias("delay_rate"),
            _avg(2).alias("avg_delay"),
        )
        .orderBy("year", "month")
    )


def with_period(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("period", ff.period_label(F.col("year"), F.col("month")))


def delay_cause_distribution(flights: DataFrame) -> DataFrame:
    """Count and percent of each cause among flights with any delay."""
    counts = (
        flights.where("delay_minutes > 0").groupBy("delay_cause").agg(_n().alias("count"))
    )
    return _with_share(counts, "count", "pct", 2, 100.0).orderBy(F.desc("count"), "delay_cause")


def _with_share(counts: DataFrame, count: str, name: str, places: int, scale: float) -> DataFrame:
    """Adds each group's part of the total. The input is already one row per group."""
    from pyspark.sql import Window

    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(name, share(F.col(count), total, places, scale))


def hourly_delay_pattern(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("dep_hour")
        .agg(
            _avg(2).alias("avg_delay"),
            share(_delayed(), _n(), 4).alias("delay_rate"),
            _n().alias("flight_count"),
        )
        .orderBy("dep_hour")
    )


def row_slots(df: DataFrame, key: str, row_counts) -> DataFrame:
    """Adds ``slot``: the smallest n in ``row_counts`` whose first n rows hold the row.

    Rows are taken in the order of md5(key), which must be unique; rows beyond the
    largest n are left out. A plain ordered limit pulls n rows through one task. Here rows
    are counted in 65,536 hash ranges; a range that no n falls into is kept as a whole,
    and only the ranges holding a cut are ranked.
    """
    from pyspark.sql import Window

    sizes = sorted(row_counts)
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, 4))
    counts = hashed.groupBy("_b").agg(_n().alias("_n"))
    # The window holds 16^4 rows at most, whatever the size of df; so does the broadcast.
    ranges = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_b")))
    ranges = ranges.withColumn("_before", F.col("_upto") - F.col("_n"))
    cut = F.lit(False)
    for n in sizes:
        cut = cut | ((F.col("_before") < n) & (F.col("_upto") > n))
    ranges = ranges.where(F.col("_before") < sizes[-1]).select("_b", "_before", "_upto", cut.alias("_cut"))
    placed = hashed.join(F.broadcast(ranges), "_b")

    def smallest_holding(rank: Column) -> Column:
        slot = F.lit(None).cast("bigint")
        for n in reversed(sizes):
            slot = F.when(rank <= n, F.lit(n).cast("bigint")).otherwise(slot)
        return slot

    whole = placed.where("NOT _cut").select(*df.columns, smallest_holding(F.col("_upto")).alias("slot"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    ranked = placed.where("_cut").withColumn("_rank", F.col("_before") + rank)
    part = ranked.select(*df.columns, smallest_holding(F.col("_rank")).alias("slot"))
    return whole.unionByName(part.where(F.col("slot").isNotNull()))


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows in the order of md5(key)."""
    return row_slots(df, key, [n]).drop("slot")


def carrier_summary(flights: DataFrame) -> DataFrame:
    return flights.groupBy("carrier").agg(
        _n().alias("total_flights"),
        share(_n() - _delayed(), _n(), 4).alias("on_time_pct"),
        _avg(2).alias("avg_delay"),
    )


def scale_sweep(flights: DataFrame, row_counts=(1_000_000, 2_000_000)) -> DataFrame:
    """The carrier summary over the first n flights, for each n, in one pass.

    Flights are summed per (carrier, slot); the first n flights are the slots up to n.
    """
    sums = row_slots(flights, "flight_id", row_counts).groupBy("carrier", "slot").agg(
        _n().alias("n"), _delayed().alias("d"), F.sum(_delay()).alias("t")
    )
    sizes = F.array(*[F.lit(n).cast("bigint") for n in sorted(row_counts)])
    per_size = sums.select("carrier", "n", "d", "t", F.explode(
        F.filter(sizes, lambda n: n >= F.col("slot"))).alias("row_count"))
    n = F.sum("n")
    return (
        per_size.groupBy("carrier", "row_count")
        .agg(
            n.alias("total_flights"),
            share(n - F.sum("d"), n, 4).alias("on_time_pct"),
            mean_of_tenths(F.sum("t"), n, 2).alias("avg_delay"),
        )
        .orderBy("row_count", F.desc("on_time_pct"), "carrier")
    )


def timed_sweep(flights: DataFrame, row_counts=(1_000_000, 2_000_000)) -> list[dict]:
    """Wall-clock time of the summary at each size."""
    results = []
    for n in row_counts:
        started = time.perf_counter()
        rows = carrier_summary(first_rows(flights, "flight_id", n)).count()
        results.append({
            "query_name": "on_time_by_carrier", "row_count": n,
            "elapsed_ms": round((time.perf_counter() - started) * 1000, 1), "result_rows": rows,
        })
    return results


def overall_stats(flights: DataFrame) -> DataFrame:
    """Totals, delay rate and the mean delay over all flights."""
    return flights.agg(
        _n().alias("total_flights"),
        F.coalesce(_delayed(), F.lit(0).cast("bigint")).alias("delayed_flights"),
        F.coalesce(share(_delayed(), _n(), 3), F.lit(0.0)).alias("delay_rate"),
        F.coalesce(_avg(1), F.lit(0.0)).alias("mean_delay_minutes"),
    )


def top_delay_routes(flights: DataFrame, n: int = 5) -> DataFrame:
    route = ff.route_label(F.col("origin"), F.col("destination"))
    return (
        flights.groupBy("origin", "destination")
        .agg(_avg(4).alias("exact"), _n().alias("flight_count"))
        .orderBy(F.desc("exact"), "origin", "destination")
        .limit(n)
        .select(route.alias("route"), round_dp(F.col("exact"), 1).alias("avg_delay"), "flight_count")
    )


def kpi_row(flights: DataFrame) -> DataFrame:
    """Dashboard figures; here the mean is over flights with a delay only."""
    late = F.when(F.col("delay_minutes") > 0, _delay())
    return flights.agg(
        _n().alias("total_flights"),
        _delayed().alias("delayed_flights"),
        share(_delayed(), _n(), 3).alias("delay_rate"),
        mean_of_tenths(F.sum(late), F.count(late), 1).alias("mean_delay_when_delayed"),
    )


def cause_shares(flights: DataFrame) -> DataFrame:
    """Share of every cause value, `none` included."""
    counts = flights.groupBy("delay_cause").agg(_n().alias("n"))
    return _with_share(counts, "n", "share", 3, 1.0).orderBy(F.desc("n"), "delay_cause")


def mean_delay_by_hour(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("dep_hour")
        .agg(_avg(4).alias("delay_minutes"))
        .orderBy("dep_hour")
    )


def top_routes_by_mean(flights: DataFrame, n: int = 10) -> DataFrame:
    return (
        flights.groupBy("origin", "destination")
        .agg(_avg(4).alias("avg_delay"), _n().alias("flights"))
        .orderBy(F.desc("avg_delay"), "origin", "destination")
        .limit(n)
        .withColumn("route", ff.route_label(F.col("origin"), F.col("destination")))
    )


def route_cause_counts(flights: DataFrame) -> DataFrame:
    return flights.groupBy("origin", "destination", "delay_cause").agg(_n().alias("count"))


def top_delayed_routes(flights: DataFrame, n: int = 10) -> DataFrame:
    """Routes with the most flights that had any delay."""
    return (
        flights.where("delay_minutes > 0")
        .groupBy(ff.route_label(F.col("origin"), F.col("destination")).alias("route"))
        .agg(_n().alias("delayed"))
        .orderBy(F.desc("delayed"), "route")
        .limit(n)
    )


def route_cause_pivot(flights: DataFrame, n: int = 10) -> DataFrame:
    """Cause counts of the top delayed routes, one column per cause, in rank order.

    One pass: counts per (route, cause) feed both the pivot and the ranking.
    """
    counted = (
        route_cause_counts(flights)
        .groupBy(ff.route_label(F.col("origin"), F.col("destination")).alias("route"))
        .agg(
            *[F.coalesce(F.sum(F.when(F.col("delay_cause") == c, F.col("count"))), F.lit(0)).alias(c)
              for c in dims.DELAY_CAUSES],
            F.sum(F.when(F.col("delay_cause") != dims.NO_CAUSE, F.col("count"))).alias("delayed"),
        )
        .where("delayed > 0")
    )
    return (
        counted.orderBy(F.desc("delayed"), "route").limit(n)
        .select("route", *dims.DELAY_CAUSES, "delayed")
    )


def route_delay_matrix(flights: DataFrame, top_n: int = 30, codes=dims.NETWORK_CODES) -> DataFrame:
    """Origin x destination mean delay of the top routes, zero where not listed."""
    return (
        delay_by_route(flights, top_n)
        .groupBy("origin").pivot("destination", list(codes)).agg(F.avg("avg_delay"))
        .na.fill(0.0)
        .orderBy("origin")
    )


def numeric_summary(flights: DataFrame, columns: dict[str, int]) -> DataFrame:
    """count, mean, stddev, min, quartiles and max of each column.

    ``columns`` maps a column to its number of decimals. Values are counted as scaled
    integers, so moments are exact sums and quartiles exact interpolations over a
    histogram of distinct values.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.lit(10 ** d).alias("scale"),
                 F.rint(F.col(c) * (10 ** d)).cast("bigint").alias("v"))
        for c, d in columns.items()
    ]))
    histogram = (
        flights.select(pairs.alias("p")).where("p.v IS NOT NULL")
        .groupBy("p.metric", "p.scale", "p.v").agg(_n().alias("n"))
    )
    big = "decimal(20,0)"
    n, v = F.col("n").cast(big), F.col("v").cast("decimal(18,0)")
    grouped = histogram.groupBy("metric", "scale").agg(
        F.sum("n").alias("count"),
        F.sum(v * F.col("n").cast("decimal(18,0)")).cast("double").alias("s1"),
        F.sum((v * v).cast(big) * F.col("n").cast("decimal(17,0)")).cast("double").alias("s2"),
        F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
    )
    scale, count = F.col("scale"), F.col("count")
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / count) / (count - 1)
    return grouped.select(
        "metric", "count",
        round_dp(F.col("s1") / count / scale, 4).alias("mean"),
        round_dp(F.sqrt(variance) / scale, 4).alias("stddev"),
        (F.col("lo") / scale).alias("min"),
        *[round_dp(F.col("q")[i] / scale, 4).alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
        (F.col("hi") / scale).alias("max"),
    )


def delay_heat_grid(flights: DataFrame, airports: DataFrame, cell_deg: float = 0.25) -> DataFrame:
    """Heat weights (delay / 180) around each origin, summed per grid cell.

    Points are spread up to half a degree around the airport by a hash of the flight id,
    so the picture does not change between runs.
    """
    late = flights.where("delay_minutes > 0").join(
        F.broadcast(airports.select(F.col("code").alias("origin"), "lat", "lon")), "origin"
    )

    def offset(first: int) -> Column:
        digest = F.substring(F.md5("flight_id"), first, 4)
        return F.conv(digest, 16, 10).cast("double") / 65536.0 - 0.5

    return (
        late.groupBy(
            F.floor((F.col("lat") + offset(1)) / cell_deg).alias("cell_lat"),
            F.floor((F.col("lon") + offset(5)) / cell_deg).alias("cell_lon"),
        )
        .agg(_n().alias("points"), F.sum(_delay()).alias("_t"))
        .select("cell_lat", "cell_lon", "points", round_dp(F.col("_t") / 1800.0, 4).alias("weight"))
    )


def path_layer_counts(flights: DataFrame) -> DataFrame:
    """Flights per map layer: on time, delayed, severely delayed."""
    return flights.groupBy(ff.delay_band(F.col("delay_minutes")).alias("layer")).agg(_n().alias("flights"))
