"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runestone.session import settle


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): the smallest node that can be reached, for every linked node.

    Every round takes the smallest label among the neighbours, which is combined before the
    shuffle however many a node has, and then the label's own label, so that paths halve. Each
    round is a table; it ends when no label changes.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).filter("a <> b")
    edges = settle(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = settle(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")))
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("component").alias("near"))
        nearest = edges.join(of_other, "other").groupBy("node").agg(F.min("near").alias("near"))
        lower = labels.join(nearest, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = settle(
            lower.join(of_label, "component", "left")
            .select("node", "before", F.least("component", F.coalesce("further", "component")).alias("component"))
        )
        labels = step.select("node", "component")
        if step.filter("component <> before").isEmpty():
            return labels
