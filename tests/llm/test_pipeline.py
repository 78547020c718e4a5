"""The corpus pipeline on the small tables and on odd rows."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from kinship.llm import minhash, queries

NAMES = ["quality", "near_duplicates", "secrets", "mixture", "tokens"]


def test_stages_are_five_and_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_every_stage_works_on_what_the_last_one_kept(spark, small, tmp_path):
    docs = small("documents")
    truth = {r["doc_id"]: r for r in small("labels").collect()}
    folder = "/root/testdata/sf0.001"
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder)
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        were = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert ids <= were
        clean = {i for i in were if i in truth and truth[i]["quality"] == 1 and truth[i]["toxic"] == 0}
        if name == "quality":
            bad = {i for i in were if i in truth and truth[i]["quality"] == 0}
            assert len(ids & clean) >= 0.97 * len(clean) and len(ids & bad) <= 0.1 * len(bad)
        if name == "near_duplicates":
            judged = minhash.near_duplicates(before).collect()
            assert ids == {r["component_id"] for r in judged}
        if name == "secrets":
            assert ids == were
        if name == "mixture":
            toxic = {i for i in were if i in truth and truth[i]["toxic"] == 1}
            assert len(ids & clean) >= 0.95 * len(clean) and len(ids & toxic) < 0.6 * len(toxic)
        if name == "tokens":
            assert ids == were and "ids_sha256" in after.columns
            break
        assert after.columns == docs.columns
        path = str(tmp_path / name)
        after.write.parquet(path)
        before = spark.read.parquet(path)


@pytest.mark.parametrize("which", ["documents", "no_documents"])
def test_pipeline_of_odd_rows(spark, request, tmp_path, which):
    docs = request.getfixturevalue(which)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    ids = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect())
    assert all(n == 1 for n in ids.values()) and set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_rows_without_an_id_or_with_a_shared_one_are_judged_like_all_others(spark, small, tmp_path):
    """A third of the ids null, some shared: every stage keeps and drops the rows it would with unique ids."""
    docs = small("documents")
    blank = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 7 == 0, 7).otherwise(F.col("doc_id"))
    labels = small("labels").where("doc_id % 3 <> 0 and doc_id % 7 <> 0")
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    before, without = docs, docs.withColumn("doc_id", blank)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, before, folder).write.parquet(path)
        stage(spark, without, folder).write.parquet(path + "-odd")
        after, odd = spark.read.parquet(path), spark.read.parquet(path + "-odd")
        if name == "quality":
            assert Counter(r["text"] for r in odd.collect()) == Counter(r["text"] for r in after.collect())
        elif name == "near_duplicates":
            # One row of each group, though another where the first has no id now.
            assert odd.count() == after.count()
        elif name == "mixture":
            n, m = without.count(), odd.count()
            assert m >= 0.9 * n and odd.where("doc_id is null").count() >= 0.85 * without.where("doc_id is null").count()
        else:
            assert odd.count() == without.count()
        before, without = after, odd


def test_near_copies_without_ids_keep_one_row(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (3, text + " end"), (None, "another text of a few words"), (3, "a text of its own"), (3, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert Counter(kept) == Counter([(3, text + " end"), *rows[3:]])
