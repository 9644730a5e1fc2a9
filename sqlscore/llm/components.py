"""Connected components of an edge list, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, component`` (the smallest node id reachable) for the nodes of ``edges`` (``a``, ``b``).

    Each round takes the smallest label among a node and its neighbours, then follows the label's
    own label (which halves the distance still to go); it ends when no label changes. Labels are
    written with ``checkpoint()`` every round, so lineage stays short and lost executors cost a
    round at most. Raises if the labels still change after ``most_rounds`` rounds, which would take a
    path of astronomical length.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.where("a != b").distinct().checkpoint()
    labels = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    labels = labels.withColumn("component", F.col("node"))
    for _ in range(most_rounds):
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("_near")))
        step = (labels.join(near, F.col("node") == F.col("a"), "left")
                .select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("component")))
        jump = step.select(F.col("node").alias("_via"), F.col("component").alias("_far"))
        nxt = (step.join(jump, F.col("component") == F.col("_via"))
               .select("node", "_old", F.least("component", "_far").alias("component")).checkpoint())
        labels = nxt.select("node", "component")
        if nxt.where("component != _old").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"labels still change after {most_rounds} rounds")
