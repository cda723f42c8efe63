"""Connected components of an edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metrolake.llm import store


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for each end of the edges (a, b): label is the least vertex that v
    reaches. Every round takes the least label among the neighbours (partial
    minimum before the shuffle) and then the label of that label, so paths halve;
    each round is written as a table, and the loop ends when no label moves."""
    both = store.materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = store.materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumn("moved", F.lit(True)))
    while labels.where("moved").limit(1).count():
        near = (both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("_near")))
        step = labels.select("v", F.col("label").alias("_old")).join(near, "v").withColumn("_new", F.least("_old", "_near"))
        jump = labels.select(F.col("v").alias("_new"), F.col("label").alias("_far"))
        labels = store.materialize(step.join(jump, "_new", "left").select(
            "v", F.least("_new", F.coalesce("_far", "_new")).alias("label"))
            .join(labels.select("v", F.col("label").alias("_old")), "v").select("v", "label", (F.col("label") < F.col("_old")).alias("moved")))
    return labels.select("v", "label")
