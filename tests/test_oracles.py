"""Every registered query of the engine's own operators against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from quillon.plans.oracles import ORACLE_SQL
from quillon.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    got = QUERIES[name](spark, SF)
    want = tables.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    expected = want.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(str, rows)) == sorted(map(str, expected))
