"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a minimum per node (pre-aggregated) and a join; edges are stored
between rounds, so lineage stays short and lost executors cost one round. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One star step on edges (a > b)."""
    around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        around = around.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = around.join(least, "u")
    if both:                             # larger neighbours go to the node's smallest
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:                                # the node and its smaller neighbours go to the smallest
        out = (linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge (a long, b long): the root is the component's smallest node."""
    now = scratch.store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        now = scratch.store(_star(_star(now, True), False), "edges")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
