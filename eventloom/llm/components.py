"""Connected components of an edge table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges (a, b)``; the label is the smallest node reached.

    Each round gives a node the smallest label around it and then that label's own label, which
    halves the distances, until nothing changes. Rounds are written to the shared folder; only a
    count of changes reaches the driver. Labels are taken as minima with partial sums, so a node
    with very many edges costs no task more than its share.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        nearer = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        step = stored(
            nearer.join(jump, nearer["label"] == jump["via"]).select(
                "node", "old", F.least("label", "beyond").alias("label")
            ),
            "labels",
        )
        changed = step.filter("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
