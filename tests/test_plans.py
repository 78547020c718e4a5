"""Physical plan shapes that the design relies on."""

from __future__ import annotations

import re

from support import SF_SMALL

from kinship.operators import one_record_per_id
from kinship.plans import followers, recency, visits
from kinship.plans.catalog import queries
from kinship.sources import records, text
from tools.plan_text import executed_plan


def _plan(spark, name: str, run: bool = False) -> str:
    df = queries()[name](spark, SF_SMALL)
    if run:
        df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_hobby_members_is_map_only_with_pushed_filter(spark):
    plan = _plan(spark, "hobby_members")
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#7)]" in plan
    assert "ReadSchema: struct<p_name:string,p_brand:string,p_type:string>" in plan or "p_size" not in plan


def test_top_pages_two_phase_topk_and_no_page_shuffle(spark):
    plan = _plan(spark, "top_pages", run=True)
    assert "TakeOrderedAndProject(limit=10" in plan
    assert "LeftSemi" in plan
    # The visit counts are shuffled once and reused by the id lookup.
    assert "ReusedExchange" in plan


def test_popular_users_reuses_counts(spark):
    plan = _plan(spark, "popular_users", run=True)
    assert "Subquery" in plan or "subquery" in plan
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan


def test_reciprocity_plans(spark):
    # Anti joins by both ends of an edge; the page records have some of their own, by id.
    def of_edges(plan):
        return [keys for keys in re.findall(r"Join \[([^\]]*)\][^\n]*LeftAnti", plan) if "," in keys]

    by_anti_join, one_shuffle = _plan(spark, "not_followed_back_antijoin"), _plan(spark, "not_followed_back")
    assert of_edges(by_anti_join) and not of_edges(one_shuffle)
    assert "bit_or" in one_shuffle and "bit_or" not in by_anti_join


def _text_scans(plan: str) -> int:
    return plan.count("FileScan text") + plan.count("FileScan csv")


def test_outdated_pages_reads_the_log_once(spark, micro, micro_paths):
    """From CSV and from parquet: the latest time reuses the shuffle of the last times."""
    df = recency.outdated_pages_int(micro.pages, micro.activity)
    df.collect()
    plan = executed_plan(df)
    assert plan.count("activity.csv") == 1 and "ReusedExchange" in plan
    for name in ("outdated_pages", "outdated_pages_int"):
        df = queries()[name](spark, SF_SMALL)
        df.collect()
        assert executed_plan(df).count("FileScan parquet [l_orderkey") == 1, name


def test_mixed_lines_are_read_once(spark, micro_paths):
    lines = text.read_lines(spark, ",".join(micro_paths.values()))
    df = followers.follower_count_of_records(records.follower_records(lines))
    df.collect()
    plan = executed_plan(df)
    assert _text_scans(plan) == 1 and "Join" not in plan


def test_mixed_lines_are_hashed_not_sorted(spark, micro_paths):
    """Only the last aggregate, over a row or two for each id, sorts."""
    lines = text.read_lines(spark, ",".join(micro_paths.values()))
    df = followers.follower_count_of_records(records.follower_records(lines))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    steps = [line for line in plan.splitlines() if "Aggregate(" in line]
    assert [("Sort" in line) for line in steps] == [True, True, False, False, False, False]
    assert all("nickname" in line.split("keys=")[1].split("]")[0] for line in steps[2:])


def test_one_record_per_id_sorts_only_repeated_ids(spark, micro):
    plan = one_record_per_id(micro.pages, "nickname")._jdf.queryExecution().sparkPlan().toString()
    single, chosen = plan.split("LeftSemi")[0], plan.split("LeftSemi")[1]
    assert "LeftAnti" in single and "SortAggregate" not in chosen
    # The aggregates that sort stand right above the semi join with the repeated ids.
    assert single.count("SortAggregate") == 2 and single.index("LeftAnti") < single.index("SortAggregate")
    assert plan.count("partial_count(1)") == 2


def test_lookup_broadcasts_by_size_only(spark, micro):
    """A small k is broadcast by Spark's own check; with the checks off nothing is, however large k."""
    few = visits.top_pages(micro.activity, micro.pages, k=10)
    few.collect()
    assert "BroadcastHashJoin" in executed_plan(few)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        many = visits.top_pages(micro.activity, micro.pages, k=50_000_000)
        many.collect()
        assert "Broadcast" not in executed_plan(many)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_distinct_count_is_two_level_aggregate(spark):
    plan = _plan(spark, "follower_count")
    assert "partial_count(distinct" in plan
    assert "FullOuter" in plan


def test_each_input_scanned_once_with_shuffled_joins(spark):
    """With size-based broadcasting off (as for large inputs), no plan runs a
    pipeline twice: the edge/log table is scanned once per query, except
    where two reads are the design (see below)."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for name, build in queries().items():
            df = build(spark, SF_SMALL)
            df.collect()
            plan = executed_plan(df)
            # Text queries render follows and activity as two files.
            twice = ("record_type_counts", "record_type_counts_all", "malformed_rows", "malformed_rows_narrow")
            allowed = 2 if ("text" in name or name in twice) else 1
            assert plan.count("FileScan parquet [l_orderkey") <= allowed, name
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
