"""Tasks D and F: follower counts and members more popular than average."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.operators import (
    count_by,
    dedup_then_count,
    distinct_count_by,
    full_outer_with_defaults,
    global_scalar,
    keyed,
    one_record_per_id,
)


def _edges(follows: DataFrame) -> DataFrame:
    return keyed(follows, "id2").select("id1", "id2")


def _with_names(counts: DataFrame, pages: DataFrame) -> DataFrame:
    # Aggregate first, join after: both sides have one row per key, so the
    # full outer join is a balanced sort-merge join however skewed the raw
    # follows are, and it needs no shuffle beyond those of the aggregates.
    return full_outer_with_defaults(
        one_record_per_id(pages, "nickname"),
        "id",
        counts,
        "id2",
        "id",
        {"nickname": "", "n_followers": 0},
    )


def follower_count(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, nickname, n_followers): distinct followers of every page owner and
    of every followed id. Owners nobody follows get 0; followed ids without a
    page get the nickname ''."""
    return _with_names(distinct_count_by(_edges(follows), "id2", "id1", "n_followers"), pages)


def follower_count_dedup(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """Same answer as :func:`follower_count`, planned as an explicit early
    de-duplication of (followed, follower) pairs before counting."""
    return _with_names(dedup_then_count(_edges(follows), "id2", "id1", "n_followers"), pages)


def follower_count_of_records(records: DataFrame) -> DataFrame:
    """Same answer as :func:`follower_count`, from one table of records (id,
    follower, nickname): a page record has no follower, a follow record no
    nickname, and ``id`` is the page or the followed member.

    The first two aggregates have the nickname in their key, so they hash and
    no line is sorted: different records by (id, follower, nickname), which
    spreads the followers of a hot page over all tasks, then followers by (id,
    nickname). Only the last one, over a row or two for each id, takes the
    smallest of texts, which Spark does by sorting. The records are read once;
    no join is needed.
    """
    different = keyed(records, "id").select("id", "follower", "nickname").distinct()
    counts = different.groupBy("id", "nickname").agg(F.count("follower").alias("n"))
    return counts.groupBy("id").agg(
        F.coalesce(F.min("nickname"), F.lit("")).alias("nickname"),
        F.sum("n").alias("n_followers"),
    )


def follows_received(follows: DataFrame) -> DataFrame:
    """(id, n_follows): follow rows per followed id (duplicates counted)."""
    return count_by(_edges(follows).select(F.col("id2").alias("id")), "id", "n_follows")


def _mean_of(counts: DataFrame, column: str):
    return global_scalar(counts, F.sum(column).cast("double") / F.count(F.lit(1)))


def follower_average(follows: DataFrame) -> DataFrame:
    """(average): follow rows divided by the number of distinct followed ids."""
    counts = follows_received(follows)
    return counts.agg((F.sum("n_follows").cast("double") / F.count(F.lit(1))).alias("average"))


def popular_users(follows: DataFrame) -> DataFrame:
    """(id, n_follows) of followed ids with strictly more follow rows than the
    average over followed ids. The counts are computed once: the scalar
    subquery reuses the same shuffle (``ReusedExchange``)."""
    counts = follows_received(follows)
    return counts.where(F.col("n_follows") > _mean_of(counts, "n_follows"))


def popular_users_all_owners(follows: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, n_follows) of page owners with strictly more follow rows than the
    average over all page owners (owners nobody follows count as 0)."""
    counts = follows_received(follows).withColumnRenamed("id", "_followed")
    owners = one_record_per_id(pages).join(counts, F.col("id") == F.col("_followed"), "left").select(
        "id", F.coalesce(F.col("n_follows"), F.lit(0).cast("long")).alias("n_follows")
    )
    return owners.where(F.col("n_follows") > _mean_of(owners, "n_follows"))
