"""Connected components of a stored list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached, of all nodes in ``a``, ``b``.

    Each round takes the least label among a node's neighbours, then the label of that
    label, until none changes; with the jump, chains shorten by half or more a round.
    Labels are stored every round, so that a lost executor costs no earlier round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = materialize(both, "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("_least"))
        .select("node", F.least("node", "_least").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_near"))
        )
        lower = labels.join(near, "node").select(
            "node",
            F.col("component").alias("_old"),
            F.least("component", "_near").alias("_label"),
        )
        jump = labels.select(
            F.col("node").alias("_label"), F.col("component").alias("_further")
        )
        stored = materialize(
            lower.join(jump, "_label").select(
                "node", F.least("_label", "_further").alias("component"), "_old"
            ),
            "labels",
        )
        labels = stored.drop("_old")
        if stored.where(F.col("component") != F.col("_old")).isEmpty():
            return labels
