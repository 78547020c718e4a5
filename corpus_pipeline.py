"""Corpus pipeline: stages over ``documents``, each written and read again.

The stages learn from the whole ``labels`` table. Nothing is sampled but what
a classifier is fitted on; each stage works on all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.llm import minhash, mixing, pairwise_quality, queries, secret_scan, word_bpe
from kinship.llm.common import numbered, table, written

# Rows that go to a Python worker together, where the session names no number:
# the rows are whole texts, and a batch is held on both sides.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

# Target weights of the mixture: toxic text is cut down to this share, clean text stays whole.
SHARES = {"clean": 0.98, "toxic": 0.02}


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the rest of the session, unless it sets their size itself.

    Batches change no row. The setting stays, as a stage's plan is run after
    the stage has returned it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier rejects go.

    A null or empty text is scored as an empty one; every row is judged by its
    own text, also where rows share an id or have none; without labels of both
    kinds every row stays. Further columns stay as they are.
    """
    small_batches(spark)
    return pairwise_quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the one of the smallest doc_id (rows
    without an id after all others), then of the smallest row number.

    Rows are told apart by their number, so rows that share an id or have none
    are judged by their texts like all others. Texts without a word are no
    copies of each other; they stay.
    """
    small_batches(spark)
    rows = written(numbered(docs, "_kn_row"), "pipeline-rows")
    judged = minhash.near_duplicates(rows.select(F.col("_kn_row").alias("doc_id"), "text"), words=5, share=(80, 100))
    groups = judged.select(F.col("doc_id").alias("_kn_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "_kn_row"))["_kn_row"]
    kept = groups.join(rows.select("_kn_row", "doc_id"), "_kn_row").groupBy("component_id").agg(first.alias("_kn_row"))
    return rows.join(kept.select("_kn_row"), "_kn_row", "left_semi").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the values of live secrets out of the texts; every row stays.

    A null text stays null. Rows that share an id, or have none, are searched
    and cut each by itself.
    """
    small_batches(spark)
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents at the rates that fit the target weights, each at most once.

    Rows without an id are drawn each by itself, rows that share an id by the
    same draw; a null or empty text takes the rate of its posterior. Without
    labels of both domains every row stays.
    """
    small_batches(spark)
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    domain = F.when(F.col("domain") == "toxic", "toxic").otherwise("clean")
    return mixing.mixed(docs, labelled.withColumn("domain", domain), SHARES, "clean")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts of every document, and digests of its token ids and of the decoded text.

    A null text counts as empty; every row gives a row.
    """
    small_batches(spark)
    coded = word_bpe.encode_decode(docs, queries.tokenizer_file(queries.WORD_BPE))
    return word_bpe.digest(coded)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Trained models decide in the first and the fourth stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
