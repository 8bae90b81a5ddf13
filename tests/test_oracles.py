"""Every registered query with a SQL twin must equal DuckDB on sf0.001
(rows, column names, values after sorting)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import oracle_check as oc  # noqa: E402

import __spark_entry__ as E  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in oc.TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_is_registered():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 80


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_twin(spark, duck, name):
    duck.execute(f"CREATE OR REPLACE VIEW twin AS {ORACLES[name]}")  # as the driver installs it
    sc, sr = oc.spark_rows(E.queries()[name](spark, SF_SMALL))
    dc, dr = oc.duck_rows(duck.sql("SELECT * FROM twin"))
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr, f"{name}: values differ"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "oil_price_ma7" in df.columns
