"""Connected components of an edge list, by contraction, with every step a join on tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, component (its smallest reachable node), for every node of ``edges`` (a, b).

    Each round points every node at its smallest neighbour, follows the pointers to their roots by
    doubling, and contracts the edges to the roots; at least half of the nodes go each round. A hub
    costs one row per edge: minima are combined before the shuffle and hot keys are split by
    adaptive joins. Null ends and loops are dropped; no edges give no rows. The result reads from ``scratch``.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    staged = scratch.staged
    left = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    # Pointers of each round from the nodes that were left to their roots.
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        tree = staged(least.select("node", F.least("node", "near").alias("root")), "pointers")
        while True:
            up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = (F.col("above") != F.col("root")).alias("moved")
            tree = staged(tree.join(up, "root").select("node", F.col("above").alias("root"), moved), "pointers")
            if tree.where("moved").isEmpty():
                break
            tree = tree.drop("moved")
        tree = tree.drop("moved")
        if labels is None:
            labels = tree.withColumnRenamed("root", "component")
        else:
            moved = tree.select(F.col("node").alias("component"), "root")
            labels = staged(
                labels.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component")),
                "labels",
            )
        to = tree.select("node", "root")
        contracted = (
            left.join(to.toDF("a", "ra"), "a").join(to.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        )
        left = staged(contracted.where("a <> b").distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return labels
