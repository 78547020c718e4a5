"""Typed CSV scans, the mixed-record classifier and the malformed-row policy."""

from __future__ import annotations

import pytest
from support import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kinship.sources import records, schemas, text


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_classifier_branches(spark):
    cases = {
        "1,Ann,Software Engineer,7,Reading": text.KIND_PAGE,
        "1,2,3,14600,abc": text.KIND_FOLLOWS,
        "1,2,3,1999-01-01,abc": text.KIND_ACTIVITY,
        '1,2,3,"viewed,like",500': text.KIND_ACTIVITY,
        "15265,61480,Viewed: Y62,638251": text.KIND_UNKNOWN,
        "1,2": text.KIND_MALFORMED,
        "a,,b,c,d": text.KIND_PAGE,  # empty tokens are skipped
        ",,1,2,3,4": text.KIND_FOLLOWS,
    }
    got = dict(text.classify(_lines(spark, list(cases))).select("value", "kind").collect())
    assert got == cases


def test_activity_scan_quoted_list_and_bad_rows(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "1,2,3,viewed,1950-01-01\n"
        '2,2,3,"viewed,like",1999-01-01\n'
        "3,2,x,viewed,1999-01-01\n"
        "4,2\n"
    )
    df = text.read_csv(spark, str(path), schemas.ACTIVITY, keep_corrupt=True).cache()
    got = {r.action_id: r for r in df.collect()}
    assert got[1].action_types == "viewed" and str(got[1].action_time) == "1950-01-01"
    assert got[1][schemas.CORRUPT_COLUMN] is None
    assert got[2].action_types == "viewed,like" and str(got[2].action_time) == "1999-01-01"
    assert got[3].page_id is None and got[3].by_who == 2 and got[3][schemas.CORRUPT_COLUMN] is not None
    assert got[4].page_id is None and got[4].action_time is None and got[4][schemas.CORRUPT_COLUMN] is not None
    df.unpersist()


def test_failfast_scan_raises(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("1,2,x,viewed,1999-01-01\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        text.read_activity(spark, str(path), mode="FAILFAST").collect()


def test_path_lists_know_braces():
    assert text.path_list("a,b/{x,y}.csv,c") == ["a", "b/{x,y}.csv", "c"]
    assert text.path_list("{a,{b,c}}/d,,e") == ["{a,{b,c}}/d", "e"]
    assert text.path_list("a{b,c,d}e}") == ["a{b,c,d}e}"] and text.path_list("a{b,c") == ["a{b", "c"]
    assert text.path_list(["a,b"]) == ["a,b"] and text.path_list("") == []


def test_bad_rows_are_counted_by_the_job_that_reads_them(spark, tmp_path):
    """Short and long rows, bad numbers and dates; an empty field is not bad; unread fields count too."""
    path = tmp_path / "log.csv"
    path.write_text("1,2,3,viewed,2024-01-01\n2,2\n3,x,3,viewed,2024-01-01\n4,2,3,viewed,never\n5,,3,viewed,\n6,2,3,viewed,2024-01-01,more\n 7 ,2, 3,viewed,2024-01-02\n")
    for trim, n_bad, n_gaps in ((False, 5, 5), (True, 4, 2)):
        seen = Observation()
        df = text.read_activity(spark, str(path), counted=seen, trim_numbers=trim)
        assert df.columns == schemas.ACTIVITY.fieldNames()
        plain = text.read_activity(spark, str(path), trim_numbers=trim).select("page_id", "by_who")
        assert df.select("page_id", "by_who").collect() == plain.collect()
        assert seen.get == {"n_rows": 7, "n_bad": n_bad, "n_gaps": n_gaps}
        with pytest.raises(Exception, match="malformed row"):
            text.read_activity(spark, str(path), strict=True, trim_numbers=trim).select("page_id").collect()
    (tmp_path / "good.csv").write_text("1,2,3,viewed,2024-01-01\n5,,3,viewed,\n")
    assert text.read_activity(spark, str(tmp_path / "good.csv"), strict=True).count() == 2


def test_multi_path_scan(spark, micro_paths, tmp_path):
    extra = tmp_path / "more.csv"
    extra.write_text("9,9,9,viewed,1200\n")
    joined = f"{micro_paths['activity']},{extra}"
    df = text.read_activity(spark, joined, integer_time=True)
    assert df.count() == 9
    assert text.read_activity(spark, [micro_paths["activity"], str(extra)], integer_time=True).count() == 9


def test_mixed_folder_lines(spark, micro_paths):
    lines = text.read_lines(spark, list(micro_paths.values()))
    counts = dict(records.record_type_counts(lines).collect())
    # Follow lines with a numeric date classify as follows.
    assert counts == {text.KIND_PAGE: 6, text.KIND_FOLLOWS: 12, text.KIND_ACTIVITY: 8}


def test_parse_outcomes(spark):
    lines = _lines(
        spark,
        [
            "1,2,3,viewed,1999-01-01",
            '2,2,3,"viewed,like",1999-01-01',
            "3,2,x,viewed,1999-01-01",
            "4,,3,viewed,1999-01-01",
            "5,2",
            "6,2,3,viewed,1999-01-01,extra",
            "7,2,3,,1999-01-01",
        ],
    )
    got = dict(
        text.parse_lines(lines, schemas.ACTIVITY).select(F.col("action_id"), F.col("parse")).collect()
    )
    assert got == {
        1: text.PARSE_OK,
        2: text.PARSE_OK,
        3: text.PARSE_BAD_FIELD,
        4: text.PARSE_BAD_FIELD,
        5: text.PARSE_SHORT,
        6: text.PARSE_SHORT,
        7: text.PARSE_OK,  # an empty action list is text, not an error
    }


def test_rendered_lines_round_trip(spark, micro):
    # Table rows rendered as text and parsed back give the same rows.
    back = text.parse_lines(records.page_lines(micro.pages), schemas.PAGE)
    assert rows(back.select(*schemas.PAGE_COLUMNS)) == rows(micro.pages)
    assert set(r.parse for r in back.select("parse").collect()) == {text.PARSE_OK}


def test_malformed_rows_on_mixed_lines(spark, micro):
    lines = records.mixed_lines(micro.pages, micro.follows.withColumn("rel_date", F.lit(None).cast("date")),
                                micro.activity.withColumn("action_time", F.to_date(F.lit("2000-01-01"))))
    got = rows(records.malformed_rows(lines))
    assert got == [("activity", "ok", 8), ("follows", "bad_field", 12), ("page", "bad_field", 6)]


def test_trimmed_number_scan(spark, tmp_path):
    path = tmp_path / "padded.csv"
    path.write_text("1, 2 ,3\t,viewed , 1999-01-01\n2,x,3,viewed,1999-1-1x\n")
    plain = rows(text.read_activity(spark, str(path)))
    assert plain[0][1] is None  # without trimming a padded number is unparsable
    got = rows(text.read_activity(spark, str(path), trim_numbers=True))
    assert [tuple(map(str, r)) for r in got] == [
        ("1", "2", "3", "viewed ", "1999-01-01"),
        ("2", "None", "3", "viewed", "None"),
    ]
    ints = rows(text.read_activity(spark, str(path), integer_time=True, trim_numbers=True))
    assert ints[0][:3] == (1, 2, 3) and ints[0][4] is None
