"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import hot_keys, lookup, stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, label): the smallest node of each node's component.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so chains halve; it ends when no label changes. Every
    round is stored, so a lost executor repeats one round at most. The centre
    of a large star and the label of a large component are hot keys: their
    rows are looked up by broadcast.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    centres = hot_keys(both, "b")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = lookup(both, labels.withColumnRenamed("node", "b"), "b", centres).groupBy("a").agg(F.min("label").alias("near"))
        lower = stored(labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = stored(lookup(lower, up, "label", hot_keys(lower, "label")).select("node", "old", F.col("up").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label != old").isEmpty():
            return labels
