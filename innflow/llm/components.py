"""Connected components of an edge table by hash-to-min with pointer jumping (DataFrame operations only).

Edges point from a node to a smaller one, so a component's label is its
smallest node.  A round (1) lets every node take the least label among its
neighbours and (2) replaces that label by the label of the label.  The frames
are written to the shared folder each round, which cuts the plan; only the
number of changed labels comes to the driver.  A hub node with very many
edges is one row on the aggregated side of the join and its edges
are combined map-side, so no group is held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node on an edge: label is the smallest node reachable.  No edges: no rows."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = cut_lineage(both.unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        reach = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        met = labels.join(reach, labels["node"] == reach["u"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("mid"))
        jump = labels.select(F.col("node").alias("j"), F.col("label").alias("far"))
        step = met.join(jump, met["mid"] == jump["j"], "left").select(
            "node", "old", F.least("mid", F.coalesce("far", "mid")).alias("label"))
        step = cut_lineage(step, "labels")
        changed = step.where("label <> old").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
