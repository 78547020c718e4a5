"""A third of all rows on one key: results stay exact (checked against a
brute-force computation in plain Python) with shuffled joins and AQE's
skew-join splitting switched on at a low threshold."""

from __future__ import annotations

from collections import defaultdict

import pytest
from support import rows
from pyspark.sql import functions as F

from kinship.plans import access, followers, reciprocity, recency
from kinship.sources import generate

N_USERS = 300
HOT_FOLLOWED = 7
HOT_FOLLOWER = 11

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    pages = generate.gen_pages(spark, N_USERS, seed=3)
    base = generate.gen_follows(spark, 9000, N_USERS, seed=3, partitions=8)
    # One member is followed by a third of all rows, another follows a third;
    # the hot rows are spread over every input partition, as in a real log.
    third = lambda salt: F.pmod(F.xxhash64("rel_id", F.lit(salt)), F.lit(3)) == 0
    follows = base.select(
        "rel_id",
        F.when(third("out"), F.lit(HOT_FOLLOWER)).otherwise(F.col("id1")).cast("long").alias("id1"),
        F.when(third("in"), F.lit(HOT_FOLLOWED)).otherwise(F.col("id2")).cast("long").alias("id2"),
        "rel_date",
        "rel_desc",
    ).cache()
    log = generate.gen_activity(spark, 4500, N_USERS, seed=3, partitions=8)
    hot_page = F.pmod(F.xxhash64("action_id", F.lit("page")), F.lit(3)) == 0
    activity = log.select(
        "action_id",
        "by_who",
        F.when(hot_page, F.lit(HOT_FOLLOWED)).otherwise(F.col("page_id")).cast("long").alias("page_id"),
        "action_types",
        F.unix_date("action_time").cast("long").alias("action_time"),
    ).cache()
    py = {
        "pages": [tuple(r) for r in pages.collect()],
        "follows": [(r.id1, r.id2) for r in follows.collect()],
        "activity": [(r.by_who, r.page_id, r.action_time) for r in activity.collect()],
    }
    yield pages, follows, activity, py
    follows.unpersist()
    activity.unpersist()
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_follower_counts_under_skew(skewed):
    pages, follows, _, py = skewed
    sets = defaultdict(set)
    raw = defaultdict(int)
    for a, b in py["follows"]:
        sets[b].add(a)
        raw[b] += 1
    names = {p[0]: p[1] for p in py["pages"]}
    expected = sorted(
        (i, names.get(i, ""), len(sets.get(i, ()))) for i in set(names) | set(sets)
    )
    assert rows(followers.follower_count(follows, pages)) == expected
    assert rows(followers.follows_received(follows)) == sorted(raw.items())
    average = sum(raw.values()) / len(raw)
    assert rows(followers.popular_users(follows)) == sorted((k, v) for k, v in raw.items() if v > average)


def test_access_under_skew(skewed):
    _, _, activity, py = skewed
    total, visitors = defaultdict(int), defaultdict(set)
    for who, page, _ in py["activity"]:
        total[page] += 1
        visitors[page].add(who)
    expected = sorted((p, total[p], len(visitors[p])) for p in total)
    assert rows(access.access_by_page(activity)) == expected
    assert rows(access.access_pair_rollup(activity)) == expected


def test_reciprocity_under_skew(spark, skewed):
    pages, follows, _, py = skewed
    region = {p[0]: p[3] for p in py["pages"]}
    names = {p[0]: p[1] for p in py["pages"]}
    edges = {(a, b) for a, b in py["follows"] if a in region and b in region and region[a] == region[b]}
    one_way = sorted((a, names[a], b) for a, b in edges if (b, a) not in edges)
    result = reciprocity.not_followed_back(follows, pages)
    assert rows(result) == one_way
    assert rows(reciprocity.not_followed_back_antijoin(follows, pages)) == one_way
    degree = defaultdict(lambda: [0, 0, 0])
    for a, b in edges:
        degree[a][0] += 1
        degree[b][1] += 1
        degree[a][2] += (b, a) in edges
    assert rows(reciprocity.mutual_degree(follows, pages)) == sorted((k, *v) for k, v in degree.items())
    # The edge joins ran as shuffled joins and AQE split the hot partitions.
    joined = reciprocity.same_region_edges(follows, pages)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_outdated_under_skew(skewed):
    pages, _, activity, py = skewed
    latest = max(t for _, _, t in py["activity"])
    last = defaultdict(int)
    for who, _, t in py["activity"]:
        last[who] = max(last[who], max(t, 0))
    expected = sorted((p[0], p[1]) for p in py["pages"] if latest - last.get(p[0], 0) > 90)
    assert rows(recency.outdated_pages_int(pages, activity)) == expected
