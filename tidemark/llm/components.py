"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node``, ``label``: the smallest node that ``a``-``b`` links reach, for every linked node.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so paths shorten by half or better. Every round is a written table.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.store(both, f"{name}-links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = scratch.store(labels, f"{name}-0")
    for r in range(1, 200):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        done = scratch.store(jumped, f"{name}-{r}")
        labels = done.select("node", "label")
        if r > 1:
            scratch.drop(f"{name}-{r - 2}")
        if done.where("label != old").limit(1).count() == 0:
            return labels
    raise RuntimeError("components did not settle")
