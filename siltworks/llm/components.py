"""Connected components of links by repeated least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); the component is the least node that links reach.

    Each round a node takes the least label among its neighbours', then the label that its label has, so
    labels travel twice as far from round to round. Every round is written to the shared folder; what
    comes to the driver is whether anything changed. A node with very many links meets one label per task.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        own = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        ahead = labels.select(F.col("node").alias("new"), F.col("component").alias("ahead"))
        moved = stored(own.join(ahead, "new", "left").select("node", "old", F.least("new", "ahead").alias("component")), "labels")
        labels = moved.select("node", "component")
        if not moved.filter("component != old").head(1):
            return labels
