"""Registry of the public queries: name -> callable(spark, sf_dir) -> DataFrame.

Each entry wires the driver tables (``kinship.sources.tables``) into one
plan function. Nothing is collected; every result is a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinship.functions import epoch_days
from kinship.plans import access, followers, hobbies, reciprocity, recency, visits
from kinship.plans.oracle import DRIVER_HOBBY
from kinship.sources import records
from kinship.sources.tables import Inputs

Query = Callable[[SparkSession, str], DataFrame]


def _int_time(activity: DataFrame) -> DataFrame:
    return activity.withColumn("action_time", epoch_days("action_time"))


def _mixed(t: Inputs):
    return records.typed_from_mixed(records.mixed_lines(t.pages, t.follows, t.activity))


def _from_text_follower_count(t: Inputs) -> DataFrame:
    lines = records.mixed_lines(t.pages, t.follows, t.activity)
    return followers.follower_count_of_records(records.follower_records(lines))


def _from_text_access_by_page(t: Inputs) -> DataFrame:
    _, _, activity = _mixed(t)
    return access.access_by_page(activity)


def _q(fn, view: str = "parts") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir, view))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    # Task A / C
    "hobby_frequency": _q(lambda t: hobbies.hobby_frequency(t.pages)),
    "hobby_frequency_sorted": _q(lambda t: hobbies.hobby_frequency_sorted(t.pages)),
    "hobby_members": _q(lambda t: hobbies.hobby_members(t.pages, DRIVER_HOBBY)),
    # Task B
    "page_visits": _q(lambda t: visits.page_visits(t.activity)),
    "top_pages": _q(lambda t: visits.top_pages(t.activity, t.pages, k=10)),
    # Task D
    "follower_count": _q(lambda t: followers.follower_count(t.follows, t.pages)),
    "follower_count_dedup": _q(lambda t: followers.follower_count_dedup(t.follows, t.pages)),
    # Task E
    "access_by_page": _q(lambda t: access.access_by_page(t.activity)),
    "access_by_person": _q(lambda t: access.access_by_person(t.activity)),
    "access_pair_rollup": _q(lambda t: access.access_pair_rollup(t.activity)),
    "access_distinct_first": _q(lambda t: access.access_distinct_first(t.activity)),
    "access_rendered": _q(lambda t: access.access_rendered(t.activity)),
    # Task F
    "follows_received": _q(lambda t: followers.follows_received(t.follows)),
    "follower_average": _q(lambda t: followers.follower_average(t.follows)),
    "popular_users": _q(lambda t: followers.popular_users(t.follows)),
    "popular_users_all_owners": _q(lambda t: followers.popular_users_all_owners(t.follows, t.pages)),
    # Task G
    "latest_activity": _q(lambda t: recency.latest_activity(t.activity)),
    "last_seen": _q(lambda t: recency.last_seen(t.activity)),
    "last_seen_int": _q(lambda t: recency.last_seen_int(_int_time(t.activity))),
    "outdated_pages": _q(lambda t: recency.outdated_pages(t.pages, t.activity, max_gap=90)),
    "outdated_pages_int": _q(lambda t: recency.outdated_pages_int(t.pages, _int_time(t.activity), max_gap=90)),
    # Task H
    "same_region_edges": _q(lambda t: reciprocity.same_region_edges(t.follows, t.pages)),
    "not_followed_back": _q(lambda t: reciprocity.not_followed_back(t.follows, t.pages)),
    "not_followed_back_antijoin": _q(lambda t: reciprocity.not_followed_back_antijoin(t.follows, t.pages)),
    "not_followed_back_people": _q(lambda t: reciprocity.not_followed_back_people(t.follows, t.pages)),
    "not_followed_back_rendered": _q(lambda t: reciprocity.not_followed_back_rendered(t.follows, t.pages)),
    "mutual_degree": _q(lambda t: reciprocity.mutual_degree(t.follows, t.pages)),
    # Sources: the tables rendered as mixed CSV text
    "record_type_counts": _q(lambda t: records.record_type_counts(records.mixed_lines(t.pages, t.follows, t.activity))),
    "record_type_counts_all": _q(
        lambda t: records.record_type_counts(
            records.mixed_lines(t.pages, t.follows, t.activity)
            .unionByName(records.narrow_lines(t.orders))
            .unionByName(records.customer_lines(t.customers))
        )
    ),
    "malformed_rows": _q(lambda t: records.malformed_rows(records.mixed_lines(t.pages, t.follows, t.activity))),
    "malformed_rows_narrow": _q(
        lambda t: records.malformed_rows(
            records.mixed_lines(t.pages, t.follows, t.activity).unionByName(records.narrow_lines(t.orders))
        )
    ),
    # Views in which pages have no follower, and visited or followed ids no page
    "follower_count_reversed": _q(lambda t: followers.follower_count(t.follows, t.pages), "reversed"),
    "follower_count_dedup_reversed": _q(lambda t: followers.follower_count_dedup(t.follows, t.pages), "reversed"),
    "popular_users_reversed": _q(lambda t: followers.popular_users(t.follows), "reversed"),
    "popular_users_all_owners_reversed": _q(
        lambda t: followers.popular_users_all_owners(t.follows, t.pages), "reversed"
    ),
    "follower_count_customers": _q(lambda t: followers.follower_count(t.follows, t.pages), "customers"),
    "top_pages_customers": _q(lambda t: visits.top_pages(t.activity, t.pages, k=10), "customers"),
    "outdated_pages_customers": _q(lambda t: recency.outdated_pages(t.pages, t.activity, max_gap=90), "customers"),
    "not_followed_back_customers": _q(lambda t: reciprocity.not_followed_back(t.follows, t.pages), "customers"),
    # Tasks D and E fed from one mixed text folder, as the original jobs read it
    "follower_count_from_text": _q(lambda t: _from_text_follower_count(t)),
    "access_by_page_from_text": _q(lambda t: _from_text_access_by_page(t)),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
