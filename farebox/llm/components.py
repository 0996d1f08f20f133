"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.scratch import Steps


def components(edges: DataFrame, steps: Steps, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); the label is the smallest node that is reachable.

    Each round takes the smallest label among neighbours, combined before the shuffle, and then the label of that label, so
    the rounds grow with the logarithm of the longest path. Every round is a written table.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = steps.keep(both, f"{name}-edges")
    start = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels, turn = steps.keep(start, f"{name}-0"), 0
    while True:
        turn += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        near = steps.keep(near, f"{name}-near-{turn}")
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        lower = steps.keep(lower, f"{name}-low-{turn}")
        root = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = lower.join(root, "label", "left").select("node", "was", F.least(F.col("label"), F.coalesce("root", "label")).alias("label"))
        jumped = steps.keep(jumped, f"{name}-{turn}")
        steps.drop(f"{name}-near-{turn}", f"{name}-low-{turn}", f"{name}-{turn - 1}")
        if jumped.filter(F.col("label") < F.col("was")).isEmpty():
            steps.drop(f"{name}-edges")
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
