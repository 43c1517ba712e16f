"""Every registered query with a SQL twin, on the smallest data set."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from compare import TABLES, rows_of

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_twin_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert 0 < len(rows) <= 50
    assert [r.risk_score for r in rows] == sorted((r.risk_score for r in rows), reverse=True)
