"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are joined to the smallest node of its neighbourhood:
    the larger neighbours (large star), or the smaller ones and itself (small star)."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = around.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
    joined = around.join(low, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) -> (node, label): the smallest node that each node with an edge reaches.

    A round is a large star and a small star; their number grows with the
    logarithm of the longest path. Each round's edges are written to the
    shared folder. Only two numbers a round come to the driver: the count of
    edges and a sum of their hashes, which stay the same when nothing moved.
    """
    now = written(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_star(_star(now, True), False), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    # Stars now: every edge leads from a node to its component's smallest node.
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
