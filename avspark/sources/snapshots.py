"""A log of position snapshots with age, freshness and retention rules.

The log holds one JSON row per aircraft and snapshot rather than one JSON array per
snapshot: a snapshot of any size is then written and read in parallel, never gathered
into a single value.

On disk, a log is a few data folders and a manifest (:mod:`avspark.sources.manifest`) that names the
complete snapshots in them. Readers go by the manifest alone, so a snapshot that is being written, or
whose writer died, is not seen. Retention is part of publishing: a snapshot that is no longer named is
gone, and its folder is written over by a later one. Batch jobs and streams share this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark import dims, schemas
from avspark.functions import positions
from avspark.sources import manifest

_STATE_COLUMNS = [f.name for f in schemas.AIRCRAFT_STATE.fields]


def to_log(states: DataFrame, fetched_at: Column) -> DataFrame:
    """(fetched_at, payload): each state as JSON with its altitude in feet."""
    record = F.struct(
        *_STATE_COLUMNS, positions.feet(F.col("altitude_m")).alias("altitude_ft")
    )
    return states.select(
        fetched_at.cast("bigint").alias("fetched_at"), F.to_json(record).alias("payload")
    )


def from_log(log: DataFrame) -> DataFrame:
    """States of a log; the derived altitude in feet is dropped again."""
    return log.select(
        "fetched_at", F.from_json("payload", schemas.AIRCRAFT_STATE).alias("s")
    ).select("fetched_at", "s.*")


_LOG = "fetched_at bigint, payload string"


def publish(log: DataFrame, path: str, keep: int = dims.SNAPSHOTS_KEPT, batch_id: int | None = None) -> bool:
    """Adds the snapshots of ``log`` (fetched_at, payload) to those under ``path`` and keeps the ``keep``
    newest of all. Says whether anything was published.

    Only snapshots that stay are written, in parallel; the driver learns ``keep`` times at most.
    Snapshots of one second that come by different calls stay apart. A stream gives its ``batch_id``:
    a batch that is published already is left alone, so that replays do not count twice. A writer
    that dies before the end has published nothing, and the next one uses its folder again. There
    are never more than 2 x ``keep`` + 1 folders.
    """
    spark = log.sparkSession
    found = manifest.versions(spark, path)
    old = found[0][1] if found else {"snapshots": [], "number": 0, "batch_id": None}
    if batch_id is not None and old["batch_id"] is not None and batch_id <= old["batch_id"]:
        return False
    folder = manifest.free_folder(found, lambda content: {e["folder"] for e in content["snapshots"]})
    number = old["number"] + 1
    times = log.select("fetched_at").distinct().orderBy(F.desc("fetched_at")).limit(keep).collect()
    new = [{"fetched_at": r["fetched_at"], "number": number, "folder": folder} for r in times]
    kept = sorted([*old["snapshots"], *new], key=lambda e: (-e["fetched_at"], -e["number"]))[:keep]
    fresh = [e["fetched_at"] for e in kept if e["number"] == number]
    if fresh:
        log.where(F.col("fetched_at").isin(fresh)).write.mode("overwrite").parquet(f"{path}/data/{folder}")
    last = old["batch_id"] if batch_id is None else batch_id
    manifest.publish(spark, path, {"snapshots": kept, "number": number, "batch_id": last})
    return bool(fresh)


def append_snapshot(states: DataFrame, fetched_at: Column, path: str, keep: int = dims.SNAPSHOTS_KEPT) -> bool:
    """Publishes states as snapshots of their ``fetched_at``."""
    return publish(to_log(states, fetched_at), path, keep)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(fetched_at, payload, number) of the snapshots that the newest manifest names; ``number`` tells
    snapshots of one second apart. An unpublished log is empty."""
    content = manifest.current(spark, path) or {"snapshots": []}
    folders: dict[tuple[int, int], list[int]] = {}
    for e in content["snapshots"]:
        folders.setdefault((e["folder"], e["number"]), []).append(e["fetched_at"])
    log = spark.createDataFrame([], f"{_LOG}, number bigint")
    for (folder, number), times in folders.items():
        rows = spark.read.schema(_LOG).parquet(f"{path}/data/{folder}").where(F.col("fetched_at").isin(times))
        log = log.unionByName(rows.withColumn("number", F.lit(number).cast("bigint")))
    return log


def keep_newest(log: DataFrame, n: int = dims.SNAPSHOTS_KEPT) -> DataFrame:
    """Rows of the n newest snapshots. Only the n kept times are broadcast."""
    newest = log.select("fetched_at").distinct().orderBy(F.desc("fetched_at")).limit(n)
    return log.join(F.broadcast(newest), "fetched_at", "left_semi")


def _newest_time(log: DataFrame) -> Column:
    return log.agg(F.max("fetched_at")).scalar()


def latest(log: DataFrame, now: int, max_age_s: int = dims.CACHE_MAX_AGE_S) -> DataFrame:
    """States of the newest snapshot, or none when it is older than ``max_age_s``."""
    rows = log.where(
        (F.col("fetched_at") == _newest_time(log)) & (F.lit(now) - F.col("fetched_at") <= max_age_s)
    )
    return from_log(rows)


def age_seconds(log: DataFrame, now: int) -> DataFrame:
    """Seconds since the newest snapshot; infinite for an empty log."""
    return log.agg(
        F.coalesce((F.lit(now) - F.max("fetched_at")).cast("double"), F.lit(float("inf"))).alias("age_s")
    )


def newest_time(log: DataFrame) -> int | None:
    """When the newest snapshot was fetched, by one job over that column."""
    return log.agg(F.max("fetched_at")).first()[0]


def chosen_source(newest: int | None, now: int, live: DataFrame | None) -> str:
    """The best source that has any states: "cache" (a fresh log), "live", "stale" (an older log) or "fallback".

    ``live`` is asked for its first row, and only if the log is not fresh.
    """
    age = float("inf") if newest is None else now - newest
    if age <= dims.CACHE_TTL_S:
        return "cache"
    if live is not None and not live.isEmpty():
        return "live"
    return "stale" if age <= dims.CACHE_MAX_AGE_S else "fallback"


def resolve(
    log: DataFrame, now: int, live: DataFrame | None, fallback: DataFrame, newest: int | None = None
) -> DataFrame:
    """States from the best source that has any, with its name in ``source``.

    The source is chosen first, so that its rows alone are scanned. A caller that knows the log's
    ``newest`` time saves the job that looks it up.
    """
    if newest is None:
        newest = newest_time(log)
    source = chosen_source(newest, now, live)
    if source in ("cache", "stale"):
        states = from_log(log.where(F.col("fetched_at") == newest))
    else:
        states = live if source == "live" else fallback
    return states.select(F.lit(source).alias("source"), *_STATE_COLUMNS)
