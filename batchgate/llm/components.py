"""Connected components by alternating large-star and small-star rounds.

Every round is a minimum per node and a join against it; both join sides are
written tables in the shared folder, so the lineage stays short and adaptive
execution can split a node with very many neighbours. Nothing is collected
but the two counters of the convergence test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc_least")
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "cc_least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (its component's smallest node) for every node of ``edges``
    (columns a and b of one orderable type; loops and repeats are allowed)."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                    "cc_edges")
    before = _signature(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        edges = written(_small_star(written(_large_star(edges), "cc_large")), "cc_edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own)
