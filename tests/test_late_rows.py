"""Late rows are counted over a whole run, also where recentProgress keeps a few batches only."""

from avspark.session import new_path
from avspark.streaming import jobs, sinks
from tests.test_streaming import events, feed, in_box_ids, land


def test_late_rows_of_early_batches_are_counted(spark):
    ids = in_box_ids(spark, 6)
    path = new_path(spark, "early")
    # The fourth file is late, after its hour has closed; the batches after it push its progress out.
    for i, minute in zip(ids, (10, 200, 210, 20, 300, 400), strict=True):
        land(events(spark, [(i, minute, 1)]), f"{path}/feed")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = sinks.run_to_table(
            jobs.hourly_counts(jobs.position_stream(feed(spark, f"{path}/feed"))), f"{path}/t", f"{path}/c", "update")
        assert len(query.recentProgress) <= 2
        found = sinks.read_hourly_counts(spark, f"{path}/t").collect()
        assert {r.late_rows_refused for r in found} == {1} and sum(r.reports for r in found) == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
