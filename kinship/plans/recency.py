"""Task G: the latest activity, each member's last activity, outdated pages.

A page is outdated when its owner has no activity in the ``max_gap`` days
before the latest activity in the whole log (pages whose owner was never
active included). Two time modes:

* calendar mode (:func:`outdated_pages`): the time column is a DATE or
  TIMESTAMP and the gap is ``INTERVAL max_gap DAYS``; an empty log gives an
  empty answer.
* integer mode (:func:`outdated_pages_int`): the time column is a whole
  number; a member's last time is floored at 0 and a missing latest time is
  0, so ``latest - last > max_gap`` is evaluated literally on those values.

Plan. The log is read once and reduced to the last time of each member, one
row a member and map task before the shuffle. The latest time of the log is
the maximum of those (a scalar subquery that reuses the same shuffle), and
the pages, one record an id, are left-joined to them. Rows without a member
count for the latest time, but belong to no page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.functions import trim_controls
from kinship.operators import global_scalar, keyed, one_record_per_id

DEFAULT_MAX_GAP = 90


# Stands for the member of rows that name none. The key is then never NULL, so
# the join adds no filter of its own to the aggregate, which would keep the
# scalar subquery from reusing the shuffle. No page has this id.
NO_MEMBER = -(1 << 63)


def latest_activity(activity: DataFrame) -> DataFrame:
    """(latest): the largest action time in the log."""
    return activity.agg(F.max("action_time").alias("latest"))


def last_seen(activity: DataFrame) -> DataFrame:
    """(by_who, last_seen): each member's latest action time."""
    timed = keyed(activity, "action_time", "by_who")
    return timed.groupBy("by_who").agg(F.max("action_time").alias("last_seen"))


def last_seen_int(activity: DataFrame) -> DataFrame:
    """(by_who, last_seen) in integer time mode: no member's last time is below 0."""
    seen = last_seen(activity)
    return seen.select("by_who", F.greatest("last_seen", F.lit(0).cast("long")).alias("last_seen"))


def _pages_with_last(pages: DataFrame, activity: DataFrame) -> tuple[DataFrame, Column]:
    """Pages (id, nickname) with their owner's last time (NULL: never active), and the log's latest time."""
    member = F.coalesce(F.col("by_who"), F.lit(NO_MEMBER)).alias("_member")
    last = (
        keyed(activity, "action_time")
        .select(member, "action_time")
        .groupBy("_member")
        .agg(F.max("action_time").alias("_last"))
    )
    latest = global_scalar(last, F.max("_last"))
    named = one_record_per_id(pages.withColumn("nickname", trim_controls(F.col("nickname"))), "nickname")
    return named.join(last, F.col("id") == F.col("_member"), "left"), latest


def outdated_pages(pages: DataFrame, activity: DataFrame, max_gap: int = DEFAULT_MAX_GAP) -> DataFrame:
    """(id, nickname) of pages whose owner was idle for more than ``max_gap``
    days before the latest activity (calendar time mode)."""
    seen, latest = _pages_with_last(pages, activity)
    idle = F.col("_last").isNull() | (latest - F.expr(f"INTERVAL {int(max_gap)} DAYS") > F.col("_last"))
    return seen.where(latest.isNotNull() & idle).select("id", "nickname")


def outdated_pages_int(pages: DataFrame, activity: DataFrame, max_gap: int = DEFAULT_MAX_GAP) -> DataFrame:
    """(id, nickname) of pages with ``latest - last > max_gap`` where the
    action time is a whole number (integer time mode)."""
    seen, latest = _pages_with_last(pages, activity)
    zero = F.lit(0).cast("long")
    last = F.greatest(F.coalesce(F.col("_last"), zero), zero)
    return seen.where(F.coalesce(latest, zero) - last > F.lit(int(max_gap))).select("id", "nickname")
