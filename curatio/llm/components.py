"""Connected components of an edge table by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, root) of every node that has an edge (columns ``a``, ``b``):
    ``root`` is the smallest node reachable. Each round takes the smallest
    label among the neighbours and then that label's own label, so long
    chains shorten by half at least; labels are written after each round. A
    node with many edges meets in a map-side minimum."""
    both = scratch.put(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                       .filter("a <> b").distinct(), f"{name}-edges")
    labels = scratch.put(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                         .select("node", F.least("node", "near").alias("root")), f"{name}-0")
    k = 0
    if labels.isEmpty():
        return labels
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near")))
        new = labels.join(near, "node").select("node", F.col("root").alias("was"),
                                               F.least("root", "near").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        new = new.join(up, "root", "left").select("node", "was", F.least("root", F.coalesce("upper", "root")).alias("root"))
        k += 1
        step = scratch.put(new, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        if step.filter("root <> was").isEmpty():
            return step.select("node", "root")
        labels = step.select("node", "root")
