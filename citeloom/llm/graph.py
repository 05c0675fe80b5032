"""Connected components by label spreading with shortcuts; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v. Returns node, label: the smallest node that each node can reach.

    A round takes the smallest label among the neighbours (a minimum with map-side combine, so a hub's edges are
    pre-aggregated) and then the label of that label, which shortens chains exponentially. The joins are plain
    equi-joins that adaptive execution may split where a hub or a large component is hot.
    """
    both = materialize(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("v"), "label"), "v").select(F.col("u").alias("node"), "label")
        near = seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        spread = near.join(up, "label", "left").select("node", F.least("label", "higher").alias("label"))
        new = materialize(spread, "labels")
        if new.join(labels, ["node", "label"], "left_anti").isEmpty():
            discard(labels, both)
            return new
        discard(labels)
        labels = new
