"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round is two group-minimum / join steps. The minimum is combined
map-side, so a node with a third of all edges costs one partial row per task,
and the join back is an ordinary equi-join that adaptive execution may split.
No edge or label ever reaches the driver, and each round is checkpointed in
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(arrows: DataFrame) -> DataFrame:
    """Each arrow u -> v with the smallest of u and its targets."""
    low = arrows.groupBy("u").agg(F.min("v").alias("low"))
    return arrows.join(low, "u").select("u", "v", F.least("u", "low").alias("low"))


def _round(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    large = large.where("u != v").distinct()
    down = _star(large)  # u > v in every row here
    small = down.select(F.explode(F.array(
        F.struct(F.col("u"), F.col("low").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")).select("e.*")
    return small.where("u != v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Nodes may be of any orderable type. Self-loops, repeated and reversed
    edges and nulls are harmless; an empty table gives an empty result.
    """
    pairs = (edges.where("a != b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    pairs = checkpointed(pairs)
    mark = None
    for _ in range(max_rounds):
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                         F.sum(F.hash("v", "u").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
        pairs = checkpointed(_round(pairs))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
