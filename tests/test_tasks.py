"""Every task on the micro fixture against hand-worked answers."""

from __future__ import annotations

from support import rows

from kinship.plans import access, followers, hobbies, reciprocity, recency, visits


def test_hobby_frequency(micro):
    assert rows(hobbies.hobby_frequency(micro.pages)) == [("Baking", 1), ("Chess", 2), ("Reading", 3)]


def test_hobby_frequency_trims(spark):
    pages = spark.createDataFrame(
        [(1, " Reading "), (2, "Reading"), (3, "\tReading\r"), (4, "Rock Climbing ")], "id long, fav_hobby string"
    )
    assert rows(hobbies.hobby_frequency(pages)) == [("Reading", 3), ("Rock Climbing", 1)]


def test_hobby_members_exact_match(micro):
    assert rows(hobbies.hobby_members(micro.pages, "Reading")) == [
        ("Ann", "Engineer"),
        ("Cyd", "Engineer"),
        ("Fay", "Analyst"),
    ]
    assert rows(hobbies.hobby_members(micro.pages, "reading")) == []


def test_top_pages_order_and_unknown(micro):
    got = [tuple(r) for r in visits.top_pages(micro.activity, micro.pages, k=10).collect()]
    assert got == [
        (2, "Bob", "Analyst", 3),
        (3, "Cyd", "Engineer", 3),
        (1, "Ann", "Engineer", 1),
        (77, "Unknown", "Unknown", 1),
    ]


def test_top_pages_k_limits(micro):
    got = [tuple(r) for r in visits.top_pages(micro.activity, micro.pages, k=2).collect()]
    assert got == [(2, "Bob", "Analyst", 3), (3, "Cyd", "Engineer", 3)]


def test_follower_count_full_outer(micro):
    expected = [
        (1, "Ann", 3),
        (2, "Bob", 3),
        (3, "Cyd", 0),
        (4, "Dee", 2),
        (5, "Ann", 1),
        (6, "Fay", 0),
        (98, "", 1),
        (99, "", 1),
    ]
    assert rows(followers.follower_count(micro.follows, micro.pages)) == expected
    assert rows(followers.follower_count_dedup(micro.follows, micro.pages)) == expected


def test_access_by_page_and_person(micro):
    by_page = [(1, 1, 1), (2, 3, 2), (3, 3, 3), (77, 1, 1)]
    assert rows(access.access_by_page(micro.activity)) == by_page
    assert rows(access.access_pair_rollup(micro.activity)) == by_page
    assert rows(access.access_distinct_first(micro.activity)) == [(p, d, t) for p, t, d in by_page]
    assert rows(access.access_rendered(micro.activity)) == [(p, f"{t},{d}") for p, t, d in by_page]
    assert rows(access.access_by_person(micro.activity)) == [
        (1, 3, 2),
        (2, 1, 1),
        (3, 1, 1),
        (4, 1, 1),
        (5, 1, 1),
        (42, 1, 1),
    ]


def test_popular_users(micro):
    assert rows(followers.follower_average(micro.follows)) == [(2.0,)]
    assert rows(followers.popular_users(micro.follows)) == [(1, 3), (2, 4)]
    assert rows(followers.popular_users_all_owners(micro.follows, micro.pages)) == [(1, 3), (2, 4), (4, 2)]


def test_outdated_pages_integer_mode(micro):
    # Page 2 was last seen exactly 90 before the latest time (kept), page 3
    # 91 before (outdated), page 5 only with an unparsable time, page 6 never.
    assert rows(recency.outdated_pages_int(micro.pages, micro.activity)) == [(3, "Cyd"), (5, "Ann"), (6, "Fay")]
    assert rows(recency.latest_activity(micro.activity)) == [(1000,)]
    assert rows(recency.last_seen(micro.activity)) == [(1, 1000), (2, 910), (3, 909), (4, 950), (42, 995)]


def test_outdated_pages_integer_mode_small_latest(spark, micro):
    # With the latest time at or below the gap, nothing is outdated.
    log = spark.createDataFrame([(1, 1, 50), (2, 2, 10)], "action_id long, by_who long, action_time long")
    assert rows(recency.outdated_pages_int(micro.pages, log)) == []
    empty = log.where("false")
    assert rows(recency.outdated_pages_int(micro.pages, empty)) == []


def test_outdated_pages_calendar_mode(spark, micro):
    log = spark.createDataFrame(
        [(1, 1, "2020-12-31"), (2, 2, "2020-10-02"), (3, 3, "2020-10-01"), (4, 5, None)],
        "action_id long, by_who long, action_time string",
    ).selectExpr("action_id", "by_who", "to_date(action_time) AS action_time")
    # 2020-12-31 minus 90 days is 2020-10-02: member 2 is kept, member 3 is not.
    assert rows(recency.outdated_pages(micro.pages, log)) == [(3, "Cyd"), (4, "Dee"), (5, "Ann"), (6, "Fay")]
    assert rows(recency.outdated_pages(micro.pages, log.where("false"))) == []


def test_not_followed_back(micro):
    expected = [(3, "Cyd", 1), (3, "Cyd", 2), (5, "Ann", 1)]
    assert rows(reciprocity.not_followed_back(micro.follows, micro.pages)) == expected
    assert rows(reciprocity.not_followed_back_antijoin(micro.follows, micro.pages)) == expected
    assert rows(reciprocity.not_followed_back_people(micro.follows, micro.pages)) == [(3, "Cyd"), (5, "Ann")]
    assert rows(reciprocity.not_followed_back_rendered(micro.follows, micro.pages)) == [
        (3, "Cyd follows ID 1 (No follow back)"),
        (3, "Cyd follows ID 2 (No follow back)"),
        (5, "Ann follows ID 1 (No follow back)"),
    ]


def test_same_region_edges_and_degrees(micro):
    assert rows(reciprocity.same_region_edges(micro.follows, micro.pages)) == [
        (1, 2),
        (2, 1),
        (3, 1),
        (3, 2),
        (5, 1),
        (5, 5),
    ]
    assert rows(reciprocity.mutual_degree(micro.follows, micro.pages)) == [
        (1, 1, 3, 1),
        (2, 1, 2, 1),
        (3, 2, 0, 0),
        (5, 2, 1, 1),
    ]


def test_outdated_pages_calendar_mode_time_of_day(spark, micro):
    log = spark.createDataFrame(
        [(1, 1, "2020-12-31 12:00:00"), (2, 2, "2020-10-02 12:00:00"), (3, 3, "2020-10-02 11:59:59")],
        "action_id long, by_who long, action_time string",
    ).selectExpr("action_id", "by_who", "to_timestamp_ntz(action_time) AS action_time")
    # The cut-off is exactly 90 days before the latest time, to the second.
    assert rows(recency.outdated_pages(micro.pages, log)) == [(3, "Cyd"), (4, "Dee"), (5, "Ann"), (6, "Fay")]
