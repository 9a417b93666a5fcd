"""Connected components of an edge table, by repeated minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, root): root is the smallest node reachable over the edges (a, b). Nodes without edges are absent.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    paths shorten by powers of two; each round is a written table, so lost tasks are cheap to run again.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
    both = scratch.save(both.where("node <> to").distinct(), f"{label}-edges")
    labels = scratch.save(both.groupBy("node").agg(F.min("to").alias("least")).select("node", F.least("node", "least").alias("root")), f"{label}-0")
    k = 0
    while True:
        k += 1
        near = both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("root").alias("near"))
        new = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = scratch.save(new.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), f"{label}-{k}")
        done = new.where("old <> root").isEmpty()
        scratch.drop(f"{label}-{k - 1}")
        labels = new.select("node", "root")
        if done:
            return labels
