"""The driver contract: entry(), queries() and oracle_sql() agree."""

from __future__ import annotations

import os

import duckdb
import pytest
from support import SF_SMALL

import __spark_entry__ as entry
from kinship.plans import catalog
from tools.check_oracle import TABLES, digest


def test_entry_runs(spark):
    df = entry.entry(spark)
    got = df.collect()
    assert df.columns == ["page_id", "nickname", "job_title", "visits"]
    assert len(got) == 10
    assert [r.visits for r in got] == sorted((r.visits for r in got), reverse=True)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) >= set(catalog.QUERIES)
    assert set(entry.queries()) >= set(catalog.QUERIES)


def test_without_the_optional_part(monkeypatch):
    monkeypatch.setattr(entry, "llm_queries", None)
    assert set(entry.queries()) == set(entry.oracle_sql()) == set(catalog.QUERIES)


def test_sorted_hobbies_come_in_order(spark):
    got = [r["hobby"] for r in entry.queries()["hobby_frequency_sorted"](spark, SF_SMALL).collect()]
    assert got == sorted(got) and len(got) > 1


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    o_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == o_types
    res = duck.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows) == digest(o_cols, o_rows)
