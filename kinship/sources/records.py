"""Text lines derived from the tables, the source-level queries, and the
split of a mixed folder into typed inputs.

The three inputs are rendered back into the headerless CSV lines their
files hold (Spark's own CSV writer rules: a field with a comma or quote is
quoted), with follow dates as whole day numbers and activity times as
``yyyy-MM-dd``. The lines of all three are then treated as one mixed folder:

* :func:`record_type_counts` classifies every line by its leading tokens.
* :func:`malformed_rows` parses every line with the activity schema, as a
  scan pointed at the mixed folder would, and counts the parse outcomes per
  source file.
* :func:`typed_from_mixed` keeps the lines of each kind and takes their ids
  from the tokens, which is how tasks D and E read a mixed folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions import epoch_days
from kinship.sources import schemas
from kinship.sources.text import KIND_ACTIVITY, KIND_FOLLOWS, KIND_PAGE, classify, parse_lines


def _csv_line(*cols: F.Column) -> F.Column:
    # A quote inside a quoted field is doubled, as the scans expect.
    return F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]), {"quote": '"', "escape": '"'})


def page_lines(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.lit("page").alias("source"),
        _csv_line(*[F.col(c) for c in schemas.PAGE_COLUMNS]).alias("value"),
    )


def follow_lines(follows: DataFrame) -> DataFrame:
    return follows.select(
        F.lit("follows").alias("source"),
        _csv_line(
            F.col("rel_id"), F.col("id1"), F.col("id2"), epoch_days("rel_date"), F.col("rel_desc")
        ).alias("value"),
    )


def activity_lines(activity: DataFrame) -> DataFrame:
    return activity.select(
        F.lit("activity").alias("source"),
        _csv_line(
            F.col("action_id"),
            F.col("by_who"),
            F.col("page_id"),
            F.col("action_types"),
            F.date_format(F.to_date("action_time"), "yyyy-MM-dd"),
        ).alias("value"),
    )


def mixed_lines(pages: DataFrame, follows: DataFrame, activity: DataFrame) -> DataFrame:
    return page_lines(pages).unionByName(follow_lines(follows)).unionByName(activity_lines(activity))


def record_type_counts(lines: DataFrame) -> DataFrame:
    """(kind, n_lines): lines per detected record kind."""
    return classify(lines).groupBy("kind").agg(F.count(F.lit(1)).alias("n_lines"))


def malformed_rows(lines: DataFrame) -> DataFrame:
    """(source, parse, n_lines): outcome of parsing every line as an activity
    row, per source file."""
    parsed = parse_lines(lines, schemas.ACTIVITY)
    return parsed.groupBy("source", "parse").agg(F.count(F.lit(1)).alias("n_lines"))


def narrow_lines(orders: DataFrame) -> DataFrame:
    """Lines of two fields (order, customer), as a file of another kind in the folder has them."""
    return orders.select(F.lit("orders").alias("source"), _csv_line(F.col("o_orderkey"), F.col("o_custkey")).alias("value"))


def customer_lines(customer: DataFrame) -> DataFrame:
    """Lines whose second token is a number and whose third is text: of none of the three kinds."""
    fields = ("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    return customer.select(F.lit("customer").alias("source"), _csv_line(*(F.col(c) for c in fields)).alias("value"))


def follower_records(lines: DataFrame) -> DataFrame:
    """(id, follower, nickname) of the page and follow lines of a mixed folder, for
    ``plans.followers.follower_count_of_records``: each line is read and split once."""
    kinds = classify(lines, keep_tokens=True).select("kind", "_tokens")
    is_page, is_follow = F.col("kind") == KIND_PAGE, F.col("kind") == KIND_FOLLOWS
    return kinds.where(is_page | is_follow).select(
        F.when(is_page, _token(0).try_cast("long")).otherwise(_token(2).try_cast("long")).alias("id"),
        F.when(is_follow, _token(1).try_cast("long")).alias("follower"),
        F.when(is_page, _token(1)).alias("nickname"),
    )


def _token(i: int) -> F.Column:
    return F.get(F.col("_tokens"), i)


def typed_from_mixed(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a mixed folder of lines into (pages, follows, activity) by record
    kind, taking fields from the comma tokens (empty tokens skipped) the way
    a tokenizing mapper does. Ids that are not whole numbers become NULL."""
    kinds = classify(lines, keep_tokens=True).select("kind", "_tokens")

    def as_id(i: int) -> F.Column:
        return _token(i).try_cast("long")

    pages = kinds.where(F.col("kind") == KIND_PAGE).select(
        as_id(0).alias("id"), _token(1).alias("nickname")
    )
    follows = kinds.where(F.col("kind") == KIND_FOLLOWS).select(
        as_id(1).alias("id1"), as_id(2).alias("id2")
    )
    activity = kinds.where(F.col("kind") == KIND_ACTIVITY).select(
        as_id(1).alias("by_who"), as_id(2).alias("page_id")
    )
    return pages, follows, activity
