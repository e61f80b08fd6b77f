"""Position-stream jobs. Each takes a streaming DataFrame and returns one.

State is keyed by aircraft or by (window, cell) and bounded by the watermark. Windowed
counts are combined map-side before the shuffle, so an aircraft or sector that sends a
third of all reports does not make one hot task.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from avspark import dims, schemas
from avspark.functions import geo, positions
from avspark.session import new_path, pin_utc
from avspark.sources.bindings import positions_from_events
from avspark.streaming import legs

LATE = "5 minutes"


def event_stream(spark: SparkSession, folder: str, table: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Event files as they land in ``folder``, or in the table of that name inside it.

    A table may be one file or a folder of part files: the name is given as a pattern, which
    streams accept for both. A batch takes all files there are unless the caller sets a limit.
    """
    source = f"{folder}/{table[:-1]}[{table[-1]}]" if table else folder
    reader = pin_utc(spark).readStream.schema(schemas.TABLES["events"]).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def static_side(table: DataFrame) -> DataFrame:
    """A small table that a stream joins, stored once when the stream is built.

    Batches then read its few rows, not the data that it was made from. It stays as it was at that
    time: a stream that should see newer rows is started anew from its checkpoint.
    """
    path = new_path(table.sparkSession, "static-side")
    table.coalesce(1).write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def position_stream(events: DataFrame) -> DataFrame:
    """Decoded positions with coordinates, inside the live box. Stateless."""
    states = positions_from_events(events).drop("baro_altitude", "geo_altitude")
    return states.na.drop(subset=["latitude", "longitude"]).where(
        geo.in_live_box(F.col("latitude"), F.col("longitude"))
    )


#: Reports that a task remembers; older ones are forgotten and their copies go on to the shuffle.
SEEN_ROWS = 100_000


def _first_seen(keys: list[str], seen_rows: int):
    """Passes a row on unless its task has passed an equal key among the last ``seen_rows`` ones."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: OrderedDict = OrderedDict()
        for batch in batches:
            fresh = []
            for row in zip(*[batch.column(k).to_pylist() for k in keys], strict=True):
                fresh.append(row not in seen)
                seen[row] = None
                seen.move_to_end(row)
                if len(seen) > seen_rows:
                    seen.popitem(last=False)
            yield batch.filter(pa.array(fresh, pa.bool_()))

    return once


def combined_repeats(states: DataFrame, seen_rows: int = SEEN_ROWS) -> DataFrame:
    """Rows without copies of a report that follow in the same task; a stateless step that loses no report."""
    return states.mapInArrow(_first_seen(["icao24", "ts"], seen_rows), states.schema)


def without_repeats(states: DataFrame, late: str = LATE) -> DataFrame:
    """One row per aircraft and report time; state is dropped behind the watermark.

    Copies are first dropped within each task, so that a report repeated very many times reaches
    the shuffle about once a task; what is left meets in the one stateful step.
    """
    return combined_repeats(states).withWatermark("ts", late).dropDuplicatesWithinWatermark(["icao24", "ts"])


def latest_state(states: DataFrame) -> DataFrame:
    """Newest report of each aircraft (update mode emits changed aircraft only)."""
    fields = [c for c in states.columns if c != "icao24"]
    return states.groupBy("icao24").agg(
        F.max_by(F.struct(*fields), F.struct("ts", "event_id")).alias("_s")
    ).select("icao24", "_s.*")


def hourly_counts(states: DataFrame, late: str = LATE) -> DataFrame:
    """Reports per hour. Rows whose hour has closed are refused; all rows that come in are counted
    by the observed metric ``feed``, so that the refused ones can be told exactly
    (``sinks.read_hourly_counts``)."""
    return (
        states.observe("feed", F.count(F.lit(1)).alias("rows"))
        .withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("reports"))
        .select(F.col("w.start").alias("hour_start"), "reports")
    )


def band_kpis(states: DataFrame, late: str = LATE) -> DataFrame:
    """Hourly report, airborne and ground counts per altitude band."""
    return (
        states.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour").alias("w"), positions.altitude_band(F.col("altitude_m")).alias("band"))
        .agg(
            F.count(F.lit(1)).alias("reports"),
            F.count_if(~F.col("on_ground")).alias("airborne"),
            F.count_if(F.col("on_ground")).alias("ground"),
        )
        .select(F.col("w.start").alias("hour_start"), "band", "reports", "airborne", "ground")
    )


def sliding_sector_load(
    states: DataFrame, late: str = LATE, threshold: int = dims.SECTOR_OVERLOAD
) -> DataFrame:
    """Positions per sector in one-hour windows sliding by 15 minutes, with an alert flag."""
    placed = states.withColumn("sector_id", geo.sector_id(F.col("latitude"), F.col("longitude"))).where(
        F.col("sector_id").isNotNull()
    )
    return (
        placed.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour", "15 minutes").alias("w"), "sector_id")
        .agg(F.count(F.lit(1)).alias("positions"))
        .select(
            F.col("w.start").alias("window_start"), "sector_id", "positions",
            (F.col("positions") >= threshold).alias("flow_control"),
        )
    )


def flight_legs(states: DataFrame, gap_s: int = 1800, late: str = LATE) -> DataFrame:
    """Legs of each aircraft, ended by a report on the ground or by ``gap_s`` without a report.

    Update mode, in a session of :func:`avspark.session.state_session`; ``sinks.read_legs`` reads the
    table. A leg is final once the watermark has passed its end; legs before that are flagged.
    """
    reports = states.withWatermark("ts", late).select(
        "icao24", "ts", F.unix_micros("ts").alias("ts_us"), "event_id", (~F.col("on_ground")).alias("airborne"), "altitude_m")
    return reports.groupBy("icao24").transformWithStateInPandas(
        legs.LegTracker(gap_s), outputStructType=legs.LEGS, outputMode="Update", timeMode="EventTime")


def _age_status(age_s: float) -> str:
    if age_s <= dims.CACHE_TTL_S:
        return "FRESH"
    return "STALE" if age_s <= dims.CACHE_MAX_AGE_S else "EXPIRED"


def _track_freshness(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Per aircraft: how old the known position was at each report, and when it expired."""
    def rows(found: list[tuple[int, float, str]]) -> pd.DataFrame:
        ts_ms, age_s, status = zip(*found, strict=True) if found else ((), (), ())
        return pd.DataFrame({"icao24": [key[0]] * len(found), "ts_ms": list(ts_ms), "age_s": list(age_s), "status": list(status)})

    limit_ms = dims.CACHE_MAX_AGE_S * 1000
    expiry = lambda at: (at, float(dims.CACHE_MAX_AGE_S), "EXPIRED")
    known, expired = state.get if state.exists else (None, False)
    if state.hasTimedOut:
        state.update((known, True))
        if not expired:
            yield rows([expiry(known)])
        return
    # Eight bytes for each report that one aircraft sends within a batch.
    times = np.unique(np.concatenate([np.empty(0, np.int64), *(batch["ts_ms"].to_numpy() for batch in batches)]))
    found = []
    for ts_ms in times.tolist():
        if known is not None and ts_ms <= known:
            continue
        if known is not None and ts_ms - known > limit_ms and not expired:
            found.append(expiry(known))
        age_s = 0.0 if known is None else (ts_ms - known) / 1000.0
        found.append((ts_ms, age_s, _age_status(age_s)))
        known, expired = ts_ms, False
    if found:
        yield rows(found)
    if known is not None:
        state.update((known, expired))
        if not expired:
            state.setTimeoutTimestamp(max(known + limit_ms, state.getCurrentWatermarkMs() + 1))


def freshness(states: DataFrame, late: str = LATE) -> DataFrame:
    """Freshness of every aircraft's known position at each of its reports, and its expiries.

    Each report gives (report time, age of the position known before, FRESH / STALE /
    EXPIRED); each position that outlives the limit also gives one EXPIRED row at that age.
    Reports are taken in event-time order, so the rows do not depend on how a feed is cut into
    batches, as long as batches follow each other in time; a report older than the known one
    changes nothing.
    """
    timed = states.select("icao24", F.unix_millis("ts").alias("ts_ms"))
    return (
        timed.withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", late)
        .groupBy("icao24")
        .applyInPandasWithState(
            _track_freshness,
            outputStructType="icao24 string, ts_ms bigint, age_s double, status string",
            stateStructType="known_ms bigint, expired boolean",
            outputMode="append",
            timeoutConf=GroupStateTimeout.EventTimeTimeout,
        )
    )


def with_airport_risk(states: DataFrame, latest_weather: DataFrame) -> DataFrame:
    """Stream-static join: nearest airport of each position and its current risk.

    The airport is found in the row itself; the weather side has one row per airport of
    the fixed dimension and is broadcast to every micro-batch.
    """
    near = states.withColumn("_near", geo.nearest_airport(F.col("latitude"), F.col("longitude")))
    side = latest_weather.select(F.col("airport").alias("nearest_airport"), "risk_score")
    return (
        near.withColumn("nearest_airport", F.col("_near.code"))
        .withColumn("nearest_mi", F.col("_near.dist")).drop("_near")
        .join(F.broadcast(side), "nearest_airport", "left")
    )
