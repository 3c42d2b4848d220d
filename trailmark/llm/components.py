"""Connected components of a graph of edges, as joins that halve distances each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.scratch import written


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """node, root (the smallest node of its component) of every node of `edges` (a, b: long, not null).

    Each round takes the smallest root among the neighbours and then the root of that root. Rounds are written to
    `folder`, so the plan does not grow and a lost executor costs one round at most.
    """
    edges = written(edges.select("a", "b").distinct(), folder, f"{name}_edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    labels = labels.select("node", F.least("node", "root").alias("root"), F.lit(True).alias("changed"))
    step = 0
    while True:
        labels = written(labels, folder, f"{name}_{step}")
        if labels.filter("changed").isEmpty():
            return labels.select("node", "root")
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        moved = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("at"))
        roots = labels.select(F.col("node").alias("at"), F.col("root").alias("root"))
        labels = moved.join(roots, "at").select(
            "node", F.least("at", "root").alias("root"), (F.least("at", "root") < F.col("old")).alias("changed")
        )
        step += 1
