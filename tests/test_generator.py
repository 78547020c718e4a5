"""Generator: sizes, domains and independence from partitioning."""

from __future__ import annotations

from support import rows
from pyspark.sql import functions as F

from kinship.sources import generate


def test_pages_domains(spark):
    df = generate.gen_pages(spark, n_users=500)
    assert df.count() == 500
    stats = df.agg(
        F.min("id"), F.max("id"), F.countDistinct("id"), F.min(F.length("nickname")), F.max(F.length("nickname")),
        F.min("region_code"), F.max("region_code"),
    ).first()
    assert tuple(stats[:3]) == (1, 500, 500)
    assert 10 <= stats[3] and stats[4] <= 20
    assert 1 <= stats[5] and stats[6] <= 50
    assert {r[0] for r in df.select("job_title").distinct().collect()} <= set(generate.JOB_TITLES)
    assert {r[0] for r in df.select("fav_hobby").distinct().collect()} <= set(generate.HOBBIES)
    assert df.where(~F.col("nickname").rlike("^[A-Za-z]+$")).count() == 0


def test_follows_and_activity_domains(spark):
    follows = generate.gen_follows(spark, n_follows=2000, n_users=100)
    assert follows.count() == 2000
    f = follows.agg(F.min("id1"), F.max("id2"), F.min(F.year("rel_date")), F.max(F.year("rel_date"))).first()
    assert f[0] >= 1 and f[1] <= 100 and f[2] >= 1900 and f[3] <= 2022
    lengths = follows.agg(F.min(F.length("rel_desc")), F.max(F.length("rel_desc"))).first()
    assert lengths[0] >= 20 and lengths[1] <= 50
    activity = generate.gen_activity(spark, n_activity=1000, n_users=100)
    assert activity.count() == 1000
    assert activity.where(~F.col("action_types").startswith("viewed")).count() == 0
    kinds = activity.select(F.explode(F.split("action_types", ",")).alias("a")).distinct()
    assert {r[0] for r in kinds.collect()} <= set(generate.ACTION_TYPES)
    listed = [r[0].split(",") for r in activity.select("action_types").collect()]
    assert {len(x) for x in listed} == set(range(1, len(generate.ACTION_TYPES) + 1))
    assert all(len(x) == len(set(x)) for x in listed)
    # The order varies: either of two types comes first in some rows.
    both = [x for x in listed if "like" in x and "poked" in x]
    assert {x.index("like") < x.index("poked") for x in both} == {True, False}


def test_same_rows_for_any_partitioning(spark):
    one = generate.gen_follows(spark, n_follows=3000, n_users=50, partitions=1)
    many = generate.gen_follows(spark, n_follows=3000, n_users=50, partitions=7)
    assert rows(one) == rows(many)
    assert rows(generate.gen_activity(spark, 500, 50, partitions=1)) == rows(
        generate.gen_activity(spark, 500, 50, partitions=5)
    )


def test_generated_csv_round_trip(spark, tmp_path):
    from kinship import sinks
    from kinship.sources import text

    pages = generate.gen_pages(spark, 200)
    follows = generate.gen_follows(spark, 1000, 200)
    activity = generate.gen_activity(spark, 500, 200)
    for name, df in (("pages", pages), ("follows", follows), ("activity", activity)):
        sinks.write_csv(df, str(tmp_path / name))
    assert rows(text.read_pages(spark, str(tmp_path / "pages"))) == rows(pages)
    assert rows(text.read_follows(spark, str(tmp_path / "follows"))) == rows(follows)
    back = text.read_activity(spark, str(tmp_path / "activity"))
    assert rows(back) == rows(activity)
    # Comma lists come back whole, so the activity rows keep their width.
    assert back.where(F.col("action_types").contains(",")).count() > 0
