"""The policy for keys, the same in every plan.

* A row without its key (NULL: a short row, an empty field, an id that is no
  number) takes no part.
* A page id names one page. Where several records have one id, the record
  with the smallest nickname counts (a missing nickname after all others),
  then the smallest region code, job title and hobby, so the answer does not
  depend on the order of lines or files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order of preference among records of one id.
RECORD_ORDER = ("nickname", "region_code", "job_title", "fav_hobby")


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """The rows that have all of ``keys``."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def one_record_per_id(pages: DataFrame, *columns: str, one_aggregate: bool = False) -> DataFrame:
    """(id, *columns) of the one record that counts for each id.

    Records are counted by id first, by hash. Ids with a single record, nearly
    all, keep it as it is; a record is chosen, by an aggregate that has to
    sort, only among the records of the others. Spark broadcasts the repeated
    ids where its size check finds them few. Only ``columns`` and those that
    come before them in the order of preference are read.

    With ``one_aggregate`` all records go through the choosing aggregate: it
    sorts them, but its plan is the one in which Spark still splits the hot
    keys of the joins with edges that follow.
    """
    last = max((RECORD_ORDER.index(c) for c in columns), default=-1)
    order = RECORD_ORDER[: last + 1]
    if not order:
        return keyed(pages, "id").select("id").dropDuplicates()
    fields = [f for c in order for f in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    records = keyed(pages, "id").select("id", *order)
    if one_aggregate:
        best = records.groupBy("id").agg(F.min(F.struct(*fields)).alias("_record"))
        return best.select("id", *(F.col("_record")[c].alias(c) for c in columns))
    repeated = records.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("id")
    single = records.join(repeated, "id", "left_anti").select("id", *columns)
    best = records.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct(*fields)).alias("_record"))
    return single.unionByName(best.select("id", *(F.col("_record")[c].alias(c) for c in columns)))
