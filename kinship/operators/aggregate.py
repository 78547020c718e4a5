"""Grouped counting operators.

All of them are plain ``groupBy().agg()`` calls. Spark plans each as a
partial aggregate before the shuffle and a final one after it, so a key that
holds a third of all rows reaches the exchange as one row per map task, not
as a third of the data. Distinct counts are planned as two aggregates: the
first shuffle is keyed by (group, value), the second by group, and neither
holds one group's set of values in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(keys: str | Column | Sequence[str | Column]) -> list[str | Column]:
    if isinstance(keys, (str, Column)):
        return [keys]
    return list(keys)


def count_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """``count(*)`` per key."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def distinct_count_by(df: DataFrame, key: str, value: str, name: str = "n_distinct") -> DataFrame:
    """Number of distinct ``value`` per ``key`` (NULL values are not counted)."""
    return df.groupBy(key).agg(F.count_distinct(value).alias(name))


def dedup_then_count(df: DataFrame, key: str, value: str, name: str = "n_distinct") -> DataFrame:
    """Same answer as :func:`distinct_count_by`, written as an explicit early
    de-duplication of (key, value) pairs followed by a count."""
    return (
        df.where(F.col(value).isNotNull())
        .select(key, value)
        .dropDuplicates([key, value])
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(name))
    )


def total_and_distinct(
    df: DataFrame,
    key: str,
    value: str,
    total: str = "n_total",
    distinct: str = "n_distinct",
) -> DataFrame:
    """Rows per key and distinct values per key in one aggregation."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(total),
        F.count_distinct(value).alias(distinct),
    )


def pair_rollup(
    df: DataFrame,
    key: str,
    value: str,
    total: str = "n_total",
    distinct: str = "n_distinct",
) -> DataFrame:
    """Two-level roll-up: count (key, value) pairs, then per key the sum of
    the pair counts (total) and the number of pairs (distinct values)."""
    pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_pair_n"))
    return pairs.groupBy(key).agg(
        F.sum("_pair_n").alias(total),
        F.count(value).alias(distinct),
    )


def global_scalar(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate used as a scalar (planned as a scalar subquery;
    its result is one value, so handing it to every task is bounded)."""
    return df.agg(expr.alias("_scalar")).scalar()
