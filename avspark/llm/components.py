"""Connected components of a table of links, as smallest reachable ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.llm.common import drop, stored


def components(links: DataFrame) -> DataFrame:
    """A stored table (id, component) for every id of ``links`` (columns a, b): the smallest id reachable.

    Each round takes the smallest label among neighbours, then the label of that label, so
    that paths halve. Every round is written to the shared folder. Minima combine before
    they are shuffled, and joins are between stored tables, so that a hub can be split.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = stored(labels, "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        lower = stored(
            labels.join(near, labels.id == near.a)
            .select("id", F.least("component", "near").alias("component"), F.col("component").alias("was")), "labels")
        drop(labels)
        if lower.where("component <> was").isEmpty():
            found = stored(lower.select("id", "component"), "components")
            drop(both, lower)
            return found
        up = lower.select(F.col("id").alias("via"), F.col("component").alias("further"))
        labels = stored(
            lower.join(up, F.col("component") == F.col("via"))
            .select("id", F.least("component", "further").alias("component")), "labels")
        drop(lower)
