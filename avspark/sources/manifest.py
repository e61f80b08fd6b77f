"""A commit log that names what is complete under a path.

A writer first writes its data to folders that nothing names yet, then publishes a version that
names them. A version is one row, written to a slot that no reader of the version before looks at,
so that a reader sees either the old version or the new one, never half of one. The last
:data:`SLOTS` versions exist; a version's content is small and bounded by whoever publishes it.
One writer at a time may publish under a path; any number may read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

SLOTS = 4
_SCHEMA = "version long, content string"


def versions(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """The published versions that still exist, newest first."""
    try:
        rows = (
            spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
            .parquet(f"{path}/manifest").collect())
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []
    return sorted(((r["version"], json.loads(r["content"])) for r in rows), key=lambda v: -v[0])


def free_folder(found: list[tuple[int, dict]], named: Callable[[dict], set[int]]) -> int:
    """A folder number that neither the newest version names nor the one before, which may still be read."""
    taken = set().union(*(named(content) for _, content in found[:2]))
    return min(set(range(len(taken) + 1)) - taken)


def current(spark: SparkSession, path: str) -> dict | None:
    found = versions(spark, path)
    return found[0][1] if found else None


def publish(spark: SparkSession, path: str, content: dict) -> int:
    """Makes ``content`` the newest version and returns its number."""
    found = versions(spark, path)
    number = found[0][0] + 1 if found else 1
    row = spark.createDataFrame([(number, json.dumps(content))], _SCHEMA).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/manifest/slot-{number % SLOTS}")
    return number
