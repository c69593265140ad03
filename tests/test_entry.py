"""The driver contract: entry, registered queries and their DuckDB oracles."""

import os
import re

import duckdb
import pytest
from paths import TESTDATA_SMALL

import __spark_entry__ as entry
from tarmac.plans import catalog


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "avg_arr_delay_min" in df.columns


def test_every_model_query_is_registered_and_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_model_query_names():
    for name in catalog.QUERIES:
        assert name != "pipeline" and not re.match(r"^op\d+_", name)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(TESTDATA_SMALL, t)}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, TESTDATA_SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    s_rows = sorted(
        (tuple(_norm(r[c]) for c in order) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t)
    )
    idx = [rel.columns.index(c) for c in order]
    d_rows = sorted(
        (tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=lambda t: tuple((x is None, str(x)) for x in t)
    )
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
