"""Slicing a tree so that no slice holds more than a given count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written


def slices(edges: DataFrame, counts: DataFrame, leaves: DataFrame, root: int | str, most: int) -> DataFrame:
    """(node, n, kind): nodes with at most ``most`` below them as slices, larger ones replaced by their children, leaves on the way as singles.

    edges: (parent, child); counts: (node, n) of leaves below; leaves: (node). A level is a few joins, and the frontier is written between levels.
    """
    frontier = counts.where(F.col("node") == root)
    out = None
    while True:
        known = frontier.join(leaves.select("node").distinct().withColumn("leaf", F.lit(True)), "node", "left")
        done = known.where("leaf OR n <= " + str(most)).select("node", "n", F.when(F.col("leaf"), "single").otherwise("slice").alias("kind"))
        out = done if out is None else out.unionByName(done)
        large = known.where(f"NOT coalesce(leaf, false) AND n > {most}").select(F.col("node").alias("parent"))
        frontier = written(edges.join(large, "parent").select(F.col("child").alias("node")).join(counts, "node"), "frontier")
        if frontier.isEmpty():
            return out


def plan_check(plan: DataFrame, counts: DataFrame, root: int | str) -> DataFrame:
    """One row: the plan's sum, the root's count and the difference."""
    a = plan.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("planned")).withColumn("__j", F.lit(1))
    b = counts.where(F.col("node") == root).agg(F.sum("n").alias("at_root")).withColumn("__j", F.lit(1))
    return a.join(b, "__j").drop("__j").withColumn("difference", F.col("at_root") - F.col("planned"))
