"""One policy for rows without a key and for repeated page ids, in every plan."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from support import rows
from pyspark.sql import functions as F

from kinship.operators import one_record_per_id
from kinship.plans import followers, hobbies, reciprocity, recency
from kinship.sources import records, text

PAGES = [
    "1,Ann,Engineer,7,Reading",
    "2",
    "x,Bad,Analyst,7,Chess",
    "3,Cyd,Engineer,7,",
    "4,Dee,Manager,9,Chess",
    "4,Abe,Manager,7,Chess",
    "4,,Manager,1,Chess",
    "5, Eve ,Manager,7,Reading",
]
FOLLOWS = ["1,1,4,100,a", "2,4,3,100,a", "3,5,1,100,a", "4,x,3,100,a", "5,1,,100,a", "6,5,3,100,a", "7,1,3,100,a", "8,9,3,100,a"]
LOG = ["1,1,2,viewed,1000", "2,,3,viewed,2000", "3,4,1,viewed,1950", "4,5,1,viewed,-5", "5,3,1,viewed,bad"]


@pytest.fixture()
def tables(spark, tmp_path):
    paths = {}
    for name, lines in (("pages", PAGES), ("follows", FOLLOWS), ("log", LOG)):
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
        paths[name] = f"{tmp_path}/{name}.csv"
    return (
        text.read_pages(spark, paths["pages"]),
        text.read_follows(spark, paths["follows"], integer_time=True),
        text.read_activity(spark, paths["log"], integer_time=True),
    )


def test_one_record_per_id(tables):
    pages, _, _ = tables
    assert rows(one_record_per_id(pages, "nickname", "region_code")) == [
        (1, "Ann", 7), (2, None, None), (3, "Cyd", 7), (4, "Abe", 7), (5, " Eve ", 7),
    ]
    assert rows(one_record_per_id(pages)) == [(1,), (2,), (3,), (4,), (5,)]


def test_hobbies_without_an_empty_group(tables):
    assert rows(hobbies.hobby_frequency(tables[0])) == [("Chess", 4), ("Reading", 2)]


def test_follower_count(tables):
    pages, follows, _ = tables
    expected = [(1, "Ann", 1), (2, "", 0), (3, "Cyd", 4), (4, "Abe", 1), (5, " Eve ", 0)]
    assert rows(followers.follower_count(follows, pages)) == expected
    assert rows(followers.follower_count_dedup(follows, pages)) == expected


def test_owners_average(tables):
    pages, follows, _ = tables
    # Follow rows: 1 -> 1, 3 -> 5, 4 -> 1; five owners, so the average is 7 / 5.
    assert rows(followers.popular_users_all_owners(follows, pages)) == [(3, 5)]


def test_outdated_pages(tables):
    pages, _, log = tables
    got = {tuple(r) for r in recency.outdated_pages_int(pages, log).collect()}
    assert got == {(1, "Ann"), (2, None), (3, "Cyd"), (5, "Eve")}
    assert rows(recency.last_seen_int(log)) == [(1, 1000), (4, 1950), (5, 0)]


def test_not_followed_back(tables):
    pages, follows, _ = tables
    expected = [(1, "Ann", 3), (1, "Ann", 4), (4, "Abe", 3), (5, "Eve", 1), (5, "Eve", 3)]
    assert rows(reciprocity.not_followed_back(follows, pages)) == expected
    assert rows(reciprocity.not_followed_back_antijoin(follows, pages)) == expected
    assert rows(reciprocity.not_followed_back_people(follows, pages)) == [(1, "Ann"), (4, "Abe"), (5, "Eve")]


def test_trimming_needs_permissive_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="PERMISSIVE"):
        text.read_pages(spark, str(tmp_path), mode="FAILFAST", trim_numbers=True)


def test_mixed_lines_with_a_hot_page(spark):
    """A third of all follows on one page: the answer is that of plain Python."""
    rng = random.Random(4)
    page_lines = [f"{i},name{i},job,region {i},Chess" for i in range(1, 40)]
    edges = [(rng.randint(1, 60), 7 if rng.random() < 0.34 else rng.randint(1, 60)) for _ in range(3000)]
    lines = page_lines + [f"{n},{a},{b},5,x" for n, (a, b) in enumerate(edges)] + ["one,two", "9,8,7"]
    df = spark.createDataFrame([(line,) for line in lines], "value string").repartition(6)
    sets = defaultdict(set)
    for a, b in edges:
        sets[b].add(a)
    names = {i: f"name{i}" for i in range(1, 40)}
    expected = sorted((i, names.get(i, ""), len(sets[i])) for i in {*names, *sets})
    assert rows(followers.follower_count_of_records(records.follower_records(df))) == expected
    pages, follows, _ = records.typed_from_mixed(df)
    assert rows(followers.follower_count(follows, pages.select("*", F.lit(1).alias("region_code")))) == expected
