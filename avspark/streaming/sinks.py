"""Running streams to tables, replay-safe."""

from __future__ import annotations

import datetime as dt
import uuid
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from avspark import dims
from avspark.sources import snapshots

_REPORTS = "batch_id long, watermark_ms long, observed map<string,bigint>"


class RunLog(StreamingQueryListener):
    """What the batches of one run report: their watermark and the metrics observed in them.

    A listener hears of every batch, while a query's own progress list forgets old ones.
    """

    def __init__(self, name: str):
        self.name, self.run_id, self.ended = name, None, Event()
        self.batches: dict[int, tuple[int, dict[str, int]]] = {}

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        observed = {
            f"{metrics}.{field}": int(value)
            for metrics, row in progress.observedMetrics.items() for field, value in row.asDict().items() if value is not None}
        mark = progress.eventTime.get("watermark")
        at = dt.datetime.fromisoformat(mark.replace("Z", "+00:00")) if mark else None
        self.batches[progress.batchId] = (round(at.timestamp() * 1000) if at else None, observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything available, one folder of ``path`` per micro-batch.

    A batch that is replayed after a lost executor or driver overwrites its own folder,
    so the table holds each batch exactly once. What the run's batches reported is kept next to the
    table, see :func:`reports`; a run that is killed leaves no reports of its batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    spark = stream.sparkSession
    log = RunLog(f"run-{uuid.uuid4().hex}")
    spark.streams.addListener(log)
    try:
        query = (
            stream.writeStream.queryName(log.name).outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # Events come in order, the end of the run last.
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
    if log.batches:
        rows = [(batch, mark, observed) for batch, (mark, observed) in sorted(log.batches.items())]
        # A run goes on where the one before ended, so its first batch names it; one row a batch.
        spark.createDataFrame(rows, _REPORTS).coalesce(1).write.mode("overwrite").parquet(f"{path}-reports/from-{rows[0][0]}")
    return query


def reports(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, watermark_ms, observed) of the batches behind the table at ``path``, over all runs."""
    return spark.read.schema(_REPORTS).option("recursiveFileLookup", "true").parquet(f"{path}-reports")


def observed_sum(spark: SparkSession, path: str, metric: str) -> Column:
    """The sum of an observed metric (``name.field``) over all batches, as a scalar."""
    return reports(spark, path).agg(F.coalesce(F.sum(F.col("observed")[metric]), F.lit(0).cast("bigint"))).scalar()


def last_watermark(spark: SparkSession, path: str) -> Column:
    """Milliseconds since 1970 of the newest watermark, as a scalar."""
    return reports(spark, path).agg(F.max("watermark_ms")).scalar()


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def read_updated(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of each key of an update-mode table."""
    table = spark.read.parquet(path)
    values = [c for c in table.columns if c not in (*keys, "batch_id")]
    return table.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, "_v.*")


def read_hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """(hour_start, reports, is_open, late_rows_refused) of a ``jobs.hourly_counts`` table.

    An hour is open while the watermark has not passed its end: it may still grow. Refused are the
    rows that were read but are in no hour, counted one by one over all batches and runs.
    """
    hours = read_updated(spark, path, ["hour_start"])
    counted = hours.agg(F.coalesce(F.sum("reports"), F.lit(0).cast("bigint"))).scalar()
    return hours.select(
        "hour_start", "reports",
        (F.unix_millis(F.col("hour_start") + F.expr("interval 1 hour")) > last_watermark(spark, path)).alias("is_open"),
        (observed_sum(spark, path, "feed.rows") - counted).alias("late_rows_refused"))


def read_legs(spark: SparkSession, path: str) -> DataFrame:
    """The legs of a ``jobs.flight_legs`` table: the closed ones, and the open ones as last told."""
    table = spark.read.parquet(path).drop("batch_id")
    newest = table.groupBy("icao24").agg(F.max("version").alias("version"))
    open_legs = table.where("is_open").join(newest, ["icao24", "version"], "left_semi")
    legs = table.where("NOT is_open").unionByName(open_legs)  # rows without a leg are in neither
    return legs.select(
        "icao24", F.timestamp_micros("start_us").alias("leg_start"), F.timestamp_micros("end_us").alias("leg_end"),
        "reports", "top_altitude_m", "ended_by", "is_open")


def run_snapshots(
    states: DataFrame, path: str, checkpoint: str, keep: int = dims.SNAPSHOTS_KEPT
) -> StreamingQuery:
    """Each micro-batch becomes one snapshot, stamped with its newest report time.

    A snapshot is seen once it is complete, see :mod:`avspark.sources.snapshots`; a replayed batch that
    was published already changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # One number comes back to the driver; the states stay distributed.
            newest = batch.agg(F.max(F.unix_seconds("ts")).alias("t")).first()["t"]
            if newest is not None:
                snapshots.publish(snapshots.to_log(batch, F.lit(newest)), path, keep, batch_id)
        finally:
            batch.unpersist()

    query = (
        states.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
