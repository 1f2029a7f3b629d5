"""Registered queries against their DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_late_rows_drops_rows(spark, con):
    kept = sum(r["n_rows"] for r in E.queries()["late_rows"](spark, SF).collect())
    closed = E.oracle_sql()["late_rows"].replace("wm.wm_before IS NULL OR", "true OR")
    undropped = sum(r[-1] for r in con.execute(closed).fetchall())
    assert 0 < kept < undropped


def test_entry_smoke(spark, con):
    df = E.entry(spark)
    assert df.count() == con.execute(f"SELECT count(*) FROM ({E.oracle_sql()['incidents']})").fetchone()[0]
    assert "incidentType" in df.columns
