"""Connected components of an edge table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import few, written


def components(edges: DataFrame) -> DataFrame:
    """Columns node and component, the smallest node that the edges (u, v) reach from each.

    Every round takes the smallest label next to each node and then the label of that label,
    so that the rounds grow with the logarithm of a path, and stops when nothing changes.
    The smallest label is aggregated before the shuffle, so a node with many edges does not
    gather them. Nodes without an edge don't appear; repeated edges and loops do no harm. The
    edges are counted, so that the tables of a few edges are few files.
    """
    edges = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL")
    rows = 2 * edges.count()
    both = written(few(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), rows, 16))
    labels = written(
        few(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("u"), F.min("v")).alias("component")), rows, 16)
    )
    while True:
        near = (
            both.join(labels, both.v == labels.node)
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.least("component", "near").alias("component"), (F.col("near") < F.col("component")).alias("changed")
        )
        hooked = written(few(hooked, rows, 17))
        if hooked.filter("changed").isEmpty():
            return labels
        up = hooked.select(F.col("node").alias("component"), F.col("component").alias("upper"))
        labels = hooked.join(up, "component").select("node", F.col("upper").alias("component"))
        labels = written(few(labels, rows, 16))
