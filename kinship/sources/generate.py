"""Deterministic synthetic pages, follows and activity, generated by Spark.

Every value is derived from ``xxhash64(row id, seed, salt)`` or a SHA-2 of
the row id, never from ``rand()``, so the same rows come out for any number
of partitions or executors, and a lost task recomputes exactly its rows.
``spark.range`` spreads the ids over the cluster, so 20 million follow rows
are never held by one process.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The domains of the generated columns.
JOB_TITLES = [
    "Software Engineer", "Data Scientist", "Product Manager", "Marketing Manager", "Sales Manager",
    "HR Manager", "Finance Manager", "Legal Manager", "IT Manager", "Operations Manager",
]
ACTION_TYPES = ["like", "comment", "share", "follow", "unfollow", "viewed", "post", "left a note", "poked"]
HOBBIES = [
    "Reading", "Gardening", "Photography", "Cooking", "Hiking", "Painting",
    "Traveling", "Swimming", "Cycling", "Running", "Fishing", "Knitting",
    "Dancing", "Writing", "Playing Guitar", "Video Gaming", "Bird Watching",
    "Woodworking", "Sculpting", "Chess", "Origami", "Baking", "Surfing",
    "Rock Climbing", "Pottery", "Astronomy", "Calligraphy", "Martial Arts",
]
FIRST_ACTION = "viewed"
N_USERS = 200_000
N_FOLLOWS = 20_000_000
N_ACTIVITY = 200_000
FIRST_YEAR, LAST_YEAR = 1900, 2022
REGIONS = 50


def _h(row: Column, seed: int, salt: str) -> Column:
    return F.xxhash64(row, F.lit(seed), F.lit(salt))


def _uniform(row: Column, seed: int, salt: str, low: int, high: int) -> Column:
    """Integer in [low, high] from the row hash."""
    return (F.pmod(_h(row, seed, salt), F.lit(high - low + 1)) + F.lit(low)).cast("long")


def _pick(row: Column, seed: int, salt: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _uniform(row, seed, salt, 1, len(values)).cast("int"))


def _text(row: Column, seed: int, salt: str, min_len: int, max_len: int, letters_only: bool) -> Column:
    """Random-looking text of min_len..max_len characters (88 available)."""
    digest = F.unhex(F.sha2(F.concat_ws(":", row.cast("string"), F.lit(seed), F.lit(salt)), 512))
    chars = F.base64(digest)
    if letters_only:
        chars = F.translate(chars, "0123456789+/=", "abcdefghijklm")
    else:
        chars = F.translate(chars, "+/=", "xyz")
    length = _uniform(row, seed, salt + "#len", min_len, max_len).cast("int")
    return F.substring(chars, F.lit(1), length)


def _year_start(row: Column, seed: int, salt: str) -> Column:
    return F.make_date(_uniform(row, seed, salt, FIRST_YEAR, LAST_YEAR).cast("int"), F.lit(1), F.lit(1))


def gen_pages(spark: SparkSession, n_users: int = N_USERS, seed: int = 0, partitions: int | None = None) -> DataFrame:
    row = F.col("id")
    return spark.range(1, n_users + 1, numPartitions=partitions).select(
        row.alias("id"),
        _text(row, seed, "nick", 10, 20, letters_only=True).alias("nickname"),
        _pick(row, seed, "job", JOB_TITLES).alias("job_title"),
        _uniform(row, seed, "region", 1, REGIONS).cast("int").alias("region_code"),
        _pick(row, seed, "hobby", HOBBIES).alias("fav_hobby"),
    )


def gen_follows(
    spark: SparkSession,
    n_follows: int = N_FOLLOWS,
    n_users: int = N_USERS,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    row = F.col("id")
    return spark.range(1, n_follows + 1, numPartitions=partitions).select(
        row.alias("rel_id"),
        _uniform(row, seed, "id1", 1, n_users).alias("id1"),
        _uniform(row, seed, "id2", 1, n_users).alias("id2"),
        _year_start(row, seed, "date").alias("rel_date"),
        _text(row, seed, "desc", 20, 50, letters_only=False).alias("rel_desc"),
    )


def gen_activity(
    spark: SparkSession,
    n_activity: int = N_ACTIVITY,
    n_users: int = N_USERS,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    row = F.col("id")
    # A sample of 1 to all but one of the action types, in random order: the types
    # by their hash in this row, cut to a random size. "viewed" always leads.
    hashed = F.transform(
        F.array(*[F.lit(a) for a in ACTION_TYPES]),
        lambda x: F.struct(F.xxhash64(row, F.lit(seed), x).alias("order"), x.alias("action")),
    )
    size = _uniform(row, seed, "size", 1, len(ACTION_TYPES) - 1).cast("int")
    drawn = F.slice(F.array_sort(hashed), F.lit(1), size)
    others = F.filter(drawn["action"], lambda x: x != FIRST_ACTION)
    actions = F.array_join(F.concat(F.array(F.lit(FIRST_ACTION)), others), ",")
    return spark.range(1, n_activity + 1, numPartitions=partitions).select(
        row.alias("action_id"),
        _uniform(row, seed, "by", 1, n_users).alias("by_who"),
        _uniform(row, seed, "page", 1, n_users).alias("page_id"),
        actions.alias("action_types"),
        _year_start(row, seed, "time").alias("action_time"),
    )
