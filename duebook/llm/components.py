"""Connected components of an edge list, as joins; nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm import common


def components(edges: DataFrame) -> DataFrame:
    """node, comp of every node on an edge (a, b); comp is the smallest node of the component.

    Each turn takes the smallest label among a node and its neighbours and then the label of
    that label, so a path shortens by half or more; a star is done in one turn. The labels are
    written after each turn, which also cuts the lineage."""
    both = common.settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = common.settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        hop = labels.select(F.col("node").alias("n2"), F.col("comp").alias("c2"))
        turned = (
            labels.join(near, labels["node"] == near["a"])
            .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
            .join(hop, F.col("comp") == F.col("n2"), "left")
            .select("node", "was", F.least("comp", "c2").alias("comp"))
        )
        turned = common.settle(turned, "labels")
        labels = turned.select("node", "comp")
        if turned.where("was <> comp").isEmpty():
            return labels
