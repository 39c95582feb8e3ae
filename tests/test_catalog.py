"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, rows_of
from postfeed.catalog.oracles import all_oracles as oracle_sql
from postfeed.catalog.queries import all_queries as queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, engine, name):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    cursor = engine.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert got == rows_of(columns, cursor.fetchall())
    assert got


def test_entry(spark):
    assert entry(spark).count() == 202
