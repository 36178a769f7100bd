"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table_bytes


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Labels take the minimum over neighbours, then over their own label's label
    (pointer jumping), so the rounds grow with the logarithm of the longest
    path. Every round is written to the shared folder; joins are between
    written tables, so Spark can split a node with very many neighbours.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges", 2 * table_bytes(edges))
    size = table_bytes(both)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels", size)
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("around"))
        )
        nearer = materialize(
            labels.join(around, "node").select("node", F.col("component").alias("before"), F.least("component", "around").alias("component")), "labels", size
        )
        jump = nearer.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = nearer.join(jump, "component", "left").select("node", "before", F.coalesce("next", "component").alias("component"))
        jumped = materialize(jumped, "labels", size)
        labels = jumped.select("node", "component")
        if jumped.where("before != component").isEmpty():
            return labels
