"""Every registered query against its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from upcheck.plans.catalog import QUERIES, oracle_sql
from tools.oracle_check import TABLES, digest

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
