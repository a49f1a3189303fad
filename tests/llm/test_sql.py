"""Queries that SQL can express, against DuckDB at sf0.001; and what is registered."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import digest
from upcheck.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from read_parquet('{SF_SMALL}/{table}.parquet{'/*' if _folder(table) else ''}')")
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    columns, rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(rows)
    assert digest(df.columns, got) == digest(columns, rows)


def _folder(table: str) -> bool:
    import os
    return os.path.isdir(f"{SF_SMALL}/{table}.parquet")


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
