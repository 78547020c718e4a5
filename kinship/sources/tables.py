"""The driver's parquet tables viewed as pages, follows and activity.

The test data is a TPC-H-like star schema, so the three social-network
inputs are projections of it (the same definitions appear as SQL views in
``kinship.plans.oracle``):

* pages    ``part``: id = p_partkey, nickname = p_name, job_title = p_type,
  region_code = p_size (1..50), fav_hobby = p_brand.
* follows  ``lineitem`` joined to ``orders``: the customer of the order
  follows the part of the line (id1 = o_custkey, id2 = l_partkey).
* activity the same join read as an access log: by_who = o_custkey visits
  page_id = l_partkey at action_time = l_shipdate.

Customer keys are a subset of part keys, so both ends of an edge live in one
id space. Whole tables are used, no rows are filtered out.

Every function is lazy and selects only the columns it renames, so Catalyst
prunes the parquet scans down to those columns and pushes later filters
through the renaming into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns each view reads, with their types. Passing them to the reader
# skips schema inference (a footer-reading job that, over a folder of many
# thousands of files, costs real time) and prunes the scan to these columns.
READ_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING, c_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in READ_SCHEMAS:
        reader = reader.schema(READ_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nickname"),
        F.col("p_type").alias("job_title"),
        F.col("p_size").alias("region_code"),
        F.col("p_brand").alias("fav_hobby"),
    )


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nickname"),
        F.col("c_mktsegment").alias("job_title"),
        F.col("c_nationkey").cast("int").alias("region_code"),
        F.col("c_mktsegment").alias("fav_hobby"),
    )


def _order_lines(spark: SparkSession, sf_dir: str, *line_columns: str) -> DataFrame:
    # Both tables grow with the scale factor, so this is an ordinary
    # shuffled equi-join on the order key (broadcast only if Spark's own size
    # check finds the orders side small).
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *line_columns)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _order_lines(spark, sf_dir, "l_shipdate", "l_returnflag")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rel_id"),
        F.col("o_custkey").alias("id1"),
        F.col("l_partkey").alias("id2"),
        F.col("l_shipdate").alias("rel_date"),
        F.col("l_returnflag").alias("rel_desc"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _order_lines(spark, sf_dir, "l_shipdate", "l_linestatus")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("action_id"),
        F.col("o_custkey").alias("by_who"),
        F.col("l_partkey").alias("page_id"),
        F.col("l_linestatus").alias("action_types"),
        F.col("l_shipdate").alias("action_time"),
    )


# Views of the tables. ``parts`` is the one above. In ``reversed`` the part
# follows the customer, so pages whose part key is no customer key have no
# follower. In ``customers`` the pages are the customers, so followed and
# visited parts beyond them have no page.
VIEWS = ("parts", "reversed", "customers")


class Inputs:
    """The three inputs of one data directory, built lazily on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, view: str = "parts"):
        if view not in VIEWS:
            raise ValueError(f"unknown view {view!r}; expected one of {', '.join(VIEWS)}")
        self.spark = spark
        self.sf_dir = sf_dir
        self.view = view

    @property
    def pages(self) -> DataFrame:
        return (customer_pages if self.view == "customers" else pages)(self.spark, self.sf_dir)

    @property
    def follows(self) -> DataFrame:
        edges = follows(self.spark, self.sf_dir)
        if self.view == "reversed":
            swapped = {"id1": F.col("id2"), "id2": F.col("id1")}
            return edges.select(*(swapped.get(c, F.col(c)).alias(c) for c in edges.columns))
        return edges

    @property
    def orders(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "orders")

    @property
    def customers(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "customer")

    @property
    def activity(self) -> DataFrame:
        return activity(self.spark, self.sf_dir)
