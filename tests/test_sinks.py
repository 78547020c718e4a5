"""Sinks write what scans read."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F
from support import rows

from kinship import sinks
from kinship.plans import hobbies
from kinship.sources import text


def test_key_value_text_sink_and_modes(spark, micro, tmp_path):
    out = str(tmp_path / "a")
    result = hobbies.hobby_frequency(micro.pages)
    sinks.write_key_value_text(result, out, "hobby")
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["Baking\t1", "Chess\t2", "Reading\t3"]
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_key_value_text(result, out, "hobby")
    sinks.write_key_value_text(result.where("hobby = 'Chess'"), out, "hobby", mode="overwrite")
    assert [r.value for r in spark.read.text(out).collect()] == ["Chess\t2"]


def part_lines(folder) -> list[str]:
    """The lines of the part files, in the order of the files' names."""
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_text_sink_in_key_order(spark, tmp_path):
    """Numbers by value, text by bytes, missing keys first; a hot key's rows are cut into ranges."""
    n = spark.range(3000).select(((F.col("id") * 7919) % 3000 - 50).alias("k"), F.lit("v").alias("v")).repartition(7)
    with_small_ranges = {"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in with_small_ranges}
    for k, v in with_small_ranges.items():
        spark.conf.set(k, v)
    try:
        sinks.write_key_value_text(n, str(tmp_path / "n"), "k", ordered=True)
        assert part_lines(tmp_path / "n") == [f"{k}\tv" for k in range(-50, 2950)]
        assert len(list((tmp_path / "n").glob("part-*"))) > 1
        words = ["b", "B", "é", "z", "a", "", "zz", "𝔘", "～", None]
        w = spark.createDataFrame([(x, i) for i, x in enumerate(words)], "k string, v int")
        sinks.write_key_value_text(w, str(tmp_path / "w"), "k", ordered=True)
        want = sorted((x for x in words if x is not None), key=str.encode)
        assert [line.split("\t")[0] for line in part_lines(tmp_path / "w")] == ["", *want]
        hot = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v")).repartition(7)
        sinks.write_key_value_text(hot, str(tmp_path / "hot"), "k", ordered=True)
        assert part_lines(tmp_path / "hot") == [f"1\t{v}" for v in range(4000)]
        assert len(list((tmp_path / "hot").glob("part-*"))) > 1
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_csv_sink_round_trip(spark, micro, tmp_path):
    out = str(tmp_path / "log")
    quoted = micro.activity
    sinks.write_csv(quoted, out)
    back = text.read_activity(spark, out, integer_time=True)
    assert rows(back) == rows(micro.activity)


def test_text_sink_keeps_every_field(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(12, None, "Eng", 3), (13, "Bob", None, None), (None, "x", "y", 1)], "id long, nickname string, job string, n long")
    sinks.write_key_value_text(df, out, ["id", "nickname", "job"], ["n"])
    assert sorted(r.value for r in spark.read.text(out).collect()) == [",x,y\t1", "12,,Eng\t3", "13,Bob,\t"]
