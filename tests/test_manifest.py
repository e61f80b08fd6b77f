"""Only what is published is seen; retention; replays; writers that die."""

import pytest
from pyspark.sql import functions as F

from avspark.session import new_path
from avspark.sources import manifest, snapshots


def log(spark, *rows):
    return spark.createDataFrame(list(rows), "fetched_at long, payload string")


def seen(spark, path):
    return sorted(tuple(r) for r in snapshots.read_log(spark, path).select("fetched_at", "payload").collect())


def test_versions(spark):
    path = new_path(spark, "manifest")
    assert manifest.current(spark, path) is None and manifest.versions(spark, path) == []
    for n in range(1, 8):
        assert manifest.publish(spark, path, {"n": n}) == n
    assert manifest.current(spark, path) == {"n": 7}
    assert [v for v, _ in manifest.versions(spark, path)] == [7, 6, 5, 4]


def test_half_a_snapshot_is_not_seen(spark, monkeypatch):
    path = new_path(spark, "half")
    assert seen(spark, path) == []
    snapshots.publish(log(spark, (1, "a"), (1, "b")), path)

    def dies(*args):
        raise RuntimeError("lost before publishing")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(manifest, "publish", dies)
        snapshots.publish(log(spark, (2, "c")), path)
    assert seen(spark, path) == [(1, "a"), (1, "b")]
    # So is one whose write fails in the middle.
    broken = log(spark, (3, "d")).withColumn("payload", F.raise_error(F.lit("executor lost")).cast("string"))
    with pytest.raises(Exception, match="executor lost"):
        snapshots.publish(broken, path)
    assert seen(spark, path) == [(1, "a"), (1, "b")]
    snapshots.publish(log(spark, (2, "c")), path)
    assert seen(spark, path) == [(1, "a"), (1, "b"), (2, "c")]


def test_readers_of_the_version_before_go_on(spark):
    """What a reader planned stays readable while the next snapshots are published."""
    path = new_path(spark, "readers")
    for t in range(3):
        snapshots.publish(log(spark, (t, f"p{t}")), path, keep=2)
    reader = snapshots.read_log(spark, path)
    snapshots.publish(log(spark, (3, "p3")), path, keep=2)
    assert sorted(r.payload for r in reader.collect()) == ["p1", "p2"]
    assert seen(spark, path) == [(2, "p2"), (3, "p3")]


def test_old_ones_go_and_old_arrivals_do_not_come_back(spark):
    path = new_path(spark, "old")
    assert snapshots.publish(log(spark, (5, "a"), (6, "b"), (7, "c"), (4, "x")), path, keep=3)
    assert not snapshots.publish(log(spark, (2, "late")), path, keep=3)
    assert seen(spark, path) == [(5, "a"), (6, "b"), (7, "c")]
    snapshots.publish(log(spark, (6, "again"), (9, "d")), path, keep=3)
    assert seen(spark, path) == [(6, "again"), (7, "c"), (9, "d")]
    assert not snapshots.publish(log(spark), path, keep=3)
    assert len(seen(spark, path)) == 3


def test_replayed_batch_changes_nothing(spark):
    path = new_path(spark, "replay")
    assert snapshots.publish(log(spark, (1, "a")), path, batch_id=0)
    assert snapshots.publish(log(spark, (2, "b")), path, batch_id=1)
    assert not snapshots.publish(log(spark, (2, "b")), path, batch_id=1)
    snapshots.publish(log(spark, (3, "by hand")), path)
    assert not snapshots.publish(log(spark, (1, "a")), path, batch_id=0)
    assert seen(spark, path) == [(1, "a"), (2, "b"), (3, "by hand")]
