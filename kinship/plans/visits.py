"""Task B: page visits and the most visited pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.operators import bounded_lookup, count_by, keyed, top_k

# Fixed value: label used for a visited page that has no page record.
UNKNOWN = "Unknown"


def page_visits(activity: DataFrame) -> DataFrame:
    """(page_id, visits): activity rows per visited page. A row listing
    several action types is one visit."""
    return count_by(keyed(activity, "page_id"), "page_id", "visits")


def top_pages(activity: DataFrame, pages: DataFrame, k: int = 10) -> DataFrame:
    """(page_id, nickname, job_title, visits) of the ``k`` most visited pages,
    most visits first, ties by ascending page id. Pages without a record are
    labelled ``Unknown``.

    Plan: one shuffle for the visit counts, a two-phase top-k, then a lookup
    that touches the page table only through a semi-join with the k winning
    ids. For a small k Spark's size check broadcasts them, and the page table
    is not shuffled; a k beyond the check makes ordinary shuffled joins.
    """
    best = top_k(page_visits(activity), "visits", k, tie_break="page_id")
    labelled = bounded_lookup(best, "page_id", pages, "id", ["nickname", "job_title"], default=UNKNOWN)
    return labelled.select("page_id", "nickname", "job_title", "visits").orderBy(F.desc("visits"), "page_id")
