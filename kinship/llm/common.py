"""Small helpers shared by the operators: table access, written
intermediates and bounded, deterministic samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinship.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    This cuts the lineage with files that every executor can read again, so a
    lost executor costs a re-read and not a recomputation.
    """
    path = shared_dir(df.sparkSession, "llm", f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Adds a row number that is unique, not dense; stable once written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def key_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def spread(*keys: Column) -> Column:
    """A uniform double in [0, 1) from a hash of the keys: the same for any partitioning."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)


def first_by_hash(
    df: DataFrame, key: str, rows: int, per: list[str] | None = None, ties: list[str] | None = None
) -> DataFrame:
    """At most ``rows`` rows (of each group ``per``), the smallest by a hash of ``key``, then by ``ties``.

    A bounded sample for fitting a model. The limit by group is a window with
    a row-number filter, which Spark evaluates as a partial top-n before the
    shuffle, so a group is never gathered in one task beyond ``rows`` rows
    from each map task.
    """
    order = [F.xxhash64(F.col(key)), F.col(key), *(F.col(name) for name in ties or ())]
    if not per:
        return df.orderBy(*order).limit(rows)
    place = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")


def one_label(labels: DataFrame, *names: str) -> DataFrame:
    """One row per document id that has a value in every named label column.

    Ids labelled more than once take the smallest value of each column; rows
    without an id are left out.
    """
    kept = labels.where(F.col("doc_id").isNotNull())
    for name in names:
        kept = kept.where(F.col(name).isNotNull())
    return kept.groupBy("doc_id").agg(*(F.min(name).cast("int").alias(name) for name in names))
