"""Tasks A and C: hobby frequency and members sharing a hobby."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions import trim_controls
from kinship.operators import count_by, keyed


def hobby_frequency(pages: DataFrame) -> DataFrame:
    """(hobby, frequency): pages per favourite hobby, the hobby trimmed of
    leading and trailing spaces and control characters. Pages without a hobby
    are not counted.

    Map-side partial counts, one shuffle of at most (#hobbies x #tasks) rows.
    """
    hobbies = pages.select(trim_controls(F.col("fav_hobby")).alias("hobby"))
    return count_by(keyed(hobbies, "hobby").where(F.col("hobby") != ""), "hobby", "frequency")


def hobby_frequency_sorted(pages: DataFrame) -> DataFrame:
    """As :func:`hobby_frequency`, ordered by hobby (a range-partitioned sort
    of the already tiny aggregate)."""
    return hobby_frequency(pages).orderBy("hobby")


def hobby_members(pages: DataFrame, hobby: str) -> DataFrame:
    """(nickname, job_title) of pages whose hobby equals ``hobby`` exactly
    (case-sensitive, untrimmed). A map-only plan: the equality is pushed into
    the parquet scan and no shuffle happens."""
    return pages.where(F.col("fav_hobby") == F.lit(hobby)).select("nickname", "job_title")
