"""Typed schemas of the three inputs: member pages, follow edges, activity log.

The source files are headerless comma-separated text with a fixed column
order, so the schemas are positional. Ids are 64-bit everywhere; region codes
are small integers. Time columns come in two flavours: a calendar value
(``DATE``/``TIMESTAMP``) as written by the data generator, or a plain number
of days, which is how the recency task reads them.
"""

from __future__ import annotations

from pyspark.sql import types as T

PAGE_COLUMNS = ["id", "nickname", "job_title", "region_code", "fav_hobby"]
FOLLOW_COLUMNS = ["rel_id", "id1", "id2", "rel_date", "rel_desc"]
ACTIVITY_COLUMNS = ["action_id", "by_who", "page_id", "action_types", "action_time"]

PAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("nickname", T.StringType()),
        T.StructField("job_title", T.StringType()),
        T.StructField("region_code", T.IntegerType()),
        T.StructField("fav_hobby", T.StringType()),
    ]
)


def follows_schema(time_type: T.DataType = T.DateType()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("rel_id", T.LongType()),
            T.StructField("id1", T.LongType()),
            T.StructField("id2", T.LongType()),
            T.StructField("rel_date", time_type),
            T.StructField("rel_desc", T.StringType()),
        ]
    )


def activity_schema(time_type: T.DataType = T.DateType()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("action_id", T.LongType()),
            T.StructField("by_who", T.LongType()),
            T.StructField("page_id", T.LongType()),
            T.StructField("action_types", T.StringType()),
            T.StructField("action_time", time_type),
        ]
    )


FOLLOWS = follows_schema()
ACTIVITY = activity_schema()
# Integer time mode: the recency task parses the time field as a whole number.
FOLLOWS_INT = follows_schema(T.LongType())
ACTIVITY_INT = activity_schema(T.LongType())

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
