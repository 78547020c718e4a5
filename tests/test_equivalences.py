"""Plan variants that must give the same answer, on the sf0.001 driver data."""

from __future__ import annotations

from support import SF_SMALL, rows
from pyspark.sql import functions as F

from kinship.plans import access, followers, reciprocity, recency
from kinship.sources.tables import Inputs


def test_distinct_follower_variants(spark):
    t = Inputs(spark, SF_SMALL)
    assert rows(followers.follower_count(t.follows, t.pages)) == rows(
        followers.follower_count_dedup(t.follows, t.pages)
    )


def test_access_variants(spark):
    t = Inputs(spark, SF_SMALL)
    base = rows(access.access_by_page(t.activity))
    assert rows(access.access_pair_rollup(t.activity)) == base
    assert rows(access.access_distinct_first(t.activity)) == [(p, d, n) for p, n, d in base]


def test_reciprocity_variants_and_partition(spark):
    t = Inputs(spark, SF_SMALL)
    one_way = rows(reciprocity.not_followed_back(t.follows, t.pages))
    assert one_way == rows(reciprocity.not_followed_back_antijoin(t.follows, t.pages))
    edges = set(rows(reciprocity.same_region_edges(t.follows, t.pages)))
    one_way_pairs = {(a, b) for a, _, b in one_way}
    # Every same-region edge is either one-way or has its reverse.
    assert one_way_pairs <= edges
    assert all((b, a) in edges for (a, b) in edges - one_way_pairs)


def test_popular_users_recomputed(spark):
    t = Inputs(spark, SF_SMALL)
    counts = dict(rows(followers.follows_received(t.follows)))
    average = sum(counts.values()) / len(counts)
    assert rows(followers.popular_users(t.follows)) == sorted((k, v) for k, v in counts.items() if v > average)
    (got_avg,) = rows(followers.follower_average(t.follows))[0]
    assert abs(got_avg - average) < 1e-9


def test_time_modes_agree_on_midnight_times(spark):
    t = Inputs(spark, SF_SMALL)
    as_days = t.activity.withColumn("action_time", F.unix_date(F.to_date("action_time")).cast("long"))
    assert rows(recency.outdated_pages(t.pages, t.activity)) == rows(recency.outdated_pages_int(t.pages, as_days))
