"""Reciprocity of directed edges: who follows whom without being followed back.

Two plans for the same answer:

* :func:`one_way_edges` puts both directions of a member pair on one key,
  ``(least(a, b), greatest(a, b))``, and ORs a direction bit per edge. One
  shuffle de-duplicates the edges and decides reciprocity at once; the
  partial aggregate before it collapses repeated edges map-side. A pair whose
  mask has one bit set is a one-way follow. A self-follow sets both bits, so
  it counts as followed back.
* :func:`anti_join_reversed` de-duplicates the edges and removes every edge
  whose reverse exists with a ``left_anti`` join on the swapped key.

Neither collects a member's followers into one task: keys are member pairs,
which are unique after de-duplication, so no single member can skew them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORWARD = 1  # edge runs from the smaller id to the larger one
BACKWARD = 2  # edge runs from the larger id to the smaller one
BOTH = FORWARD | BACKWARD


def canonical_pairs(edges: DataFrame, src: str, dst: str, carry: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row per unordered member pair with the OR of its direction bits.

    ``carry`` lists (source-side column, target-side column) pairs of
    per-member attributes (e.g. nicknames) to keep for both ends; they come
    out as ``lo_<name>`` / ``hi_<name>`` using the source-side name.
    """
    a, b = F.col(src), F.col(dst)
    forward = a < b
    direction = F.when(a < b, F.lit(FORWARD)).when(a > b, F.lit(BACKWARD)).otherwise(F.lit(BOTH))
    cols = [
        F.least(a, b).alias("lo"),
        F.greatest(a, b).alias("hi"),
        direction.alias("dir"),
    ]
    for src_attr, dst_attr in carry:
        cols.append(F.when(forward, F.col(src_attr)).otherwise(F.col(dst_attr)).alias(f"lo_{src_attr}"))
        cols.append(F.when(forward, F.col(dst_attr)).otherwise(F.col(src_attr)).alias(f"hi_{src_attr}"))
    aggs = [F.bit_or("dir").alias("mask")]
    for src_attr, _ in carry:
        aggs.append(F.any_value(f"lo_{src_attr}").alias(f"lo_{src_attr}"))
        aggs.append(F.any_value(f"hi_{src_attr}").alias(f"hi_{src_attr}"))
    return (
        edges.where(a.isNotNull() & b.isNotNull())
        .select(*cols)
        .groupBy("lo", "hi")
        .agg(*aggs)
    )


def one_way_edges(pairs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """From :func:`canonical_pairs`: the edges whose reverse is absent, as
    (src, dst, <carry of src>...).

    One projection over the pairs (no union of two filtered copies), so the
    pair aggregate and everything below it run once.
    """
    mask = F.col("mask")
    forward = mask == FORWARD
    cols = [
        F.when(forward, F.col("lo")).otherwise(F.col("hi")).alias("src"),
        F.when(forward, F.col("hi")).otherwise(F.col("lo")).alias("dst"),
    ]
    for c in carry:
        cols.append(F.when(forward, F.col(f"lo_{c}")).otherwise(F.col(f"hi_{c}")).alias(c))
    return pairs.where(mask.isin(FORWARD, BACKWARD)).select(*cols)


def degree_counts(pairs: DataFrame) -> DataFrame:
    """Per member: distinct members followed, distinct followers, and
    members followed who follow back (a self-follow counts in all three)."""
    mask = F.col("mask")
    fwd = ((mask.bitwiseAND(F.lit(FORWARD))) != 0).cast("long")
    bwd = ((mask.bitwiseAND(F.lit(BACKWARD))) != 0).cast("long")
    mutual = (mask == BOTH).cast("long")
    lo_side = F.struct(F.col("lo").alias("id"), fwd.alias("o"), bwd.alias("i"), mutual.alias("m"))
    hi_side = F.struct(F.col("hi").alias("id"), bwd.alias("o"), fwd.alias("i"), mutual.alias("m"))
    sides = F.when(F.col("lo") == F.col("hi"), F.array(lo_side)).otherwise(F.array(lo_side, hi_side))
    return (
        pairs.select(F.inline(sides))
        .groupBy("id")
        .agg(
            F.sum("o").alias("n_following"),
            F.sum("i").alias("n_followers"),
            F.sum("m").alias("n_mutual"),
        )
    )


def anti_join_reversed(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct edges (src, dst, ...) whose reverse (dst, src) is absent."""
    distinct = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).dropDuplicates([src, dst])
    reverse = distinct.select(F.col(src).alias("_r_src"), F.col(dst).alias("_r_dst"))
    cond = (F.col(src) == F.col("_r_dst")) & (F.col(dst) == F.col("_r_src"))
    return distinct.join(reverse, cond, "left_anti")
