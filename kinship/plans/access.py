"""Task E: total and distinct accesses.

The task's text asks, per member, for the number of accesses made and the
number of distinct pages accessed; its code groups by the page accessed
instead. Both are provided, together with the roll-up and column-order
variants and a rendered ``total,distinct`` text column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.operators import keyed, pair_rollup, total_and_distinct


def _log(activity: DataFrame, key: str) -> DataFrame:
    return keyed(activity, key).select("by_who", "page_id")


def access_by_page(activity: DataFrame) -> DataFrame:
    """(page_id, n_total, n_distinct): visits to each page and distinct visitors."""
    return total_and_distinct(_log(activity, "page_id"), "page_id", "by_who")


def access_by_person(activity: DataFrame) -> DataFrame:
    """(by_who, n_total, n_distinct): accesses by each member and distinct pages."""
    return total_and_distinct(_log(activity, "by_who"), "by_who", "page_id")


def access_pair_rollup(activity: DataFrame) -> DataFrame:
    """Same answer as :func:`access_by_page`, via (page, visitor) pair counts."""
    return pair_rollup(_log(activity, "page_id"), "page_id", "by_who")


def access_distinct_first(activity: DataFrame) -> DataFrame:
    """(page_id, n_distinct, n_total): the distinct-first column order."""
    return access_by_page(activity).select("page_id", "n_distinct", "n_total")


def access_rendered(activity: DataFrame) -> DataFrame:
    """(page_id, access) with access rendered as ``total,distinct``."""
    counts = access_by_page(activity)
    return counts.select(
        "page_id",
        F.concat_ws(",", F.col("n_total").cast("string"), F.col("n_distinct").cast("string")).alias("access"),
    )
