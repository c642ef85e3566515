"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, label`` of every node of ``links`` (a, b); the label is the smallest node of the component.

    Each round takes the smallest label among the neighbours and then follows labels
    once (pointer jumping), so long chains shrink by a factor each round. Labels are
    written every round; nothing but a count reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = scratch.write(both, f"{name}-edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = scratch.write(labels.select("node", F.least("node", "label").alias("label")), f"{name}-0")
    step = 0
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), F.col("label").alias("theirs")), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        pulled = labels.join(least, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "theirs").alias("label")
        )
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = pulled.join(parents, "label").select("node", "before", F.least("label", "above").alias("label"))
        step += 1
        labels = scratch.write(jumped, f"{name}-{step}")
        changed = labels.where(F.col("before") != F.col("label")).limit(1).count()
        labels = labels.select("node", "label")
        if step > 1:
            scratch.drop(f"{name}-{step - 2}")
        if not changed:
            return labels
