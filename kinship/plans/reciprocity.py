"""Task H: members who follow someone in their own region without being
followed back.

Only edges whose two ends both have a page and share a region code take part;
repeated edges count once, and a page id names one record. ``not_followed_back`` reports one row per such
one-way edge (follower id, follower nickname, followed id);
``not_followed_back_people`` reports each such follower once.

Plan: the edges meet (id, region_code) of the page table twice (follower
side, followed side). The page table grows with the data, so these are
shuffled joins unless Spark's size check lets it broadcast; a hot followed
id is split by AQE's skew-join handling. The region predicate is part of the
second join, so only same-region edges continue. Reciprocity is then decided
in one shuffle keyed by the unordered member pair (see
``kinship.operators.reciprocity``), and nicknames are looked up last, for
the answer rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions import render_follow_report, trim_controls
from kinship.operators import (
    anti_join_reversed,
    canonical_pairs,
    degree_counts,
    keyed,
    one_record_per_id,
    one_way_edges,
)


def _trimmed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("nickname", trim_controls(F.col("nickname")))


def _same_region(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id1, id2) for every follow row whose ends share a region.

    Only (id, region_code) of the pages meets the edges, so the two shuffles
    of the edge rows carry two ids and one small integer, not nicknames.
    """
    regions = one_record_per_id(_trimmed(pages), "region_code", one_aggregate=True)
    follower = regions.select(F.col("id").alias("_f_id"), F.col("region_code").alias("_f_region"))
    followed = regions.select(F.col("id").alias("_t_id"), F.col("region_code").alias("_t_region"))
    edges = keyed(follows, "id1", "id2").select("id1", "id2")
    with_follower = edges.join(follower, F.col("id1") == F.col("_f_id"), "inner")
    both = with_follower.join(
        followed,
        (F.col("id2") == F.col("_t_id")) & (F.col("_f_region") == F.col("_t_region")),
        "inner",
    )
    return both.select("id1", "id2")


def _with_nickname(one_way: DataFrame, pages: DataFrame) -> DataFrame:
    # Labels are attached after the region filter and the reciprocity test,
    # so only the (much smaller) answer meets the page table here.
    names = one_record_per_id(_trimmed(pages), "nickname").select(F.col("id").alias("_n_id"), "nickname")
    joined = one_way.join(names, F.col("src") == F.col("_n_id"), "inner")
    return joined.select(F.col("src").alias("id"), "nickname", F.col("dst").alias("followed_id"))


def same_region_edges(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id1, id2): distinct follow edges within one region, both ends known."""
    return _same_region(follows, pages).dropDuplicates()


def not_followed_back(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, nickname, followed_id) for every same-region one-way follow."""
    one_way = one_way_edges(canonical_pairs(_same_region(follows, pages), "id1", "id2"))
    return _with_nickname(one_way, pages)


def not_followed_back_antijoin(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """Same answer as :func:`not_followed_back`, planned as de-duplication
    plus a ``left_anti`` join on the reversed edge."""
    one_way = anti_join_reversed(_same_region(follows, pages), "id1", "id2")
    return _with_nickname(one_way.select(F.col("id1").alias("src"), F.col("id2").alias("dst")), pages)


def not_followed_back_people(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, nickname) of members with at least one same-region one-way follow."""
    one_way = one_way_edges(canonical_pairs(_same_region(follows, pages), "id1", "id2"))
    people = one_way.select(F.col("src"), F.lit(0).alias("dst")).dropDuplicates(["src"])
    return _with_nickname(people, pages).select("id", "nickname")


def not_followed_back_rendered(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, report) with report ``<nickname> follows ID <id> (No follow back)``."""
    rows = not_followed_back(follows, pages)
    return rows.select("id", render_follow_report(F.col("nickname"), F.col("followed_id")).alias("report"))


def mutual_degree(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, n_following, n_followers, n_mutual) over distinct same-region edges."""
    return degree_counts(canonical_pairs(_same_region(follows, pages), "id1", "id2"))
