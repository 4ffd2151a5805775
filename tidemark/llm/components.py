"""Connected components by minimum labels with pointer jumping; nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a, b).

    Each round takes the least label among a node and its neighbours, then that label's own label. Labels and edges are
    joined, never gathered: a node with very many neighbours is a skewed join, which Spark splits.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct()
    both = written(both, "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        lowered = labels.join(around, F.col("node") == F.col("a")).select(
            "node", F.least("label", "low").alias("label"), F.col("label").alias("old")
        )
        above = lowered.select(F.col("node").alias("parent"), F.col("label").alias("up"))
        jumped = lowered.join(above, F.col("label") == F.col("parent"), "left").select(
            "node", F.least("label", F.coalesce("up", "label")).alias("label"), "old"
        )
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label != old").limit(1).count():
            return labels.withColumnRenamed("label", "component")
