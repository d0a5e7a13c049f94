"""Connected components as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """The smallest id reachable from each end of ``edges`` (``a``, ``b``): id, component.

    Each round takes the least label among the neighbours, then the label of that label, so
    long paths shorten fast; rounds end when no label changes. Labels are written to the
    shared folder after each round. Sums per node are combined before they are shuffled, and
    only counts reach the driver.
    """
    links = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = materialise(links.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    while True:
        near = links.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        least = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("c1"))
        jump = labels.select(F.col("id").alias("c1"), F.col("component").alias("c2"))
        after = materialise(least.join(jump, "c1", "left").select("id", "old", F.least("c1", "c2").alias("component")), "labels")
        labels = after.select("id", "component")
        if after.filter("old <> component").isEmpty():
            return labels
