"""Operators on hand-made inputs."""

from __future__ import annotations

from support import rows

from kinship import sinks
from kinship.operators import (
    bounded_lookup,
    canonical_pairs,
    count_by,
    dedup_then_count,
    degree_counts,
    distinct_count_by,
    full_outer_with_defaults,
    one_way_edges,
    pair_rollup,
    top_k,
    total_and_distinct,
)
from kinship.plans import visits
from kinship.sources import text


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def test_counting_operators(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, None), (3, 12)], "k long, v long")
    assert rows(count_by(df, "k")) == [(1, 3), (2, 1), (3, 1)]
    assert rows(distinct_count_by(df, "k", "v")) == [(1, 2), (2, 0), (3, 1)]
    assert rows(dedup_then_count(df, "k", "v")) == [(1, 2), (3, 1)]
    assert rows(total_and_distinct(df, "k", "v")) == [(1, 3, 2), (2, 1, 0), (3, 1, 1)]
    assert rows(pair_rollup(df, "k", "v")) == [(1, 3, 2), (2, 1, 0), (3, 1, 1)]


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([(5, 2), (3, 2), (9, 1), (1, 7)], "id long, n long")
    assert [tuple(r) for r in top_k(df, "n", 3, tie_break="id").collect()] == [(1, 7), (3, 2), (5, 2)]


def test_bounded_lookup_defaults_and_duplicates(spark):
    best = spark.createDataFrame([(1, 9), (2, 8), (3, 7)], "key long, n long")
    table = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (4, "d")], "id long, label string")
    got = rows(bounded_lookup(best, "key", table, "id", ["label"], default="none"))
    assert sorted(got, key=str) == sorted([(1, 9, "a"), (2, 8, None), (3, 7, "none")], key=str)


def test_full_outer_with_defaults(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    right = spark.createDataFrame([(2, 5), (3, 6)], "k long, n long")
    got = rows(full_outer_with_defaults(left, "id", right, "k", "id", {"name": "", "n": 0}))
    assert got == [(1, "x", 0), (2, "y", 5), (3, "", 6)]


def test_canonical_pairs_masks_and_carry(spark):
    edges = spark.createDataFrame(
        [(1, 2, "p", "q"), (2, 1, "q", "p"), (3, 1, "r", "p"), (3, 1, "r", "p"), (4, 4, "s", "s"), (5, 6, "t", "u")],
        "a long, b long, na string, nb string",
    )
    pairs = canonical_pairs(edges, "a", "b", carry=[("na", "nb")])
    assert rows(pairs) == [
        (1, 2, 3, "p", "q"),
        (1, 3, 2, "p", "r"),
        (4, 4, 3, "s", "s"),
        (5, 6, 1, "t", "u"),
    ]
    assert rows(one_way_edges(pairs, carry=["na"])) == [(3, 1, "r"), (5, 6, "t")]
    assert rows(degree_counts(pairs)) == [
        (1, 1, 2, 1),
        (2, 1, 1, 1),
        (3, 1, 0, 0),
        (4, 1, 1, 1),
        (5, 1, 0, 0),
        (6, 0, 1, 0),
    ]


def test_key_value_round_trip(spark, micro, tmp_path):
    out = str(tmp_path / "top")
    best = visits.top_pages(micro.activity, micro.pages, k=10)
    sinks.write_key_value_text(best, out, ["page_id", "nickname", "job_title"], ["visits"])
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["1,Ann,Engineer\t1", "2,Bob,Analyst\t3", "3,Cyd,Engineer\t3", "77,Unknown,Unknown\t1"]
    back = text.read_key_value(spark, out, "key string, visits long")
    assert rows(back) == [("1,Ann,Engineer", 1), ("2,Bob,Analyst", 3), ("3,Cyd,Engineer", 3), ("77,Unknown,Unknown", 1)]
