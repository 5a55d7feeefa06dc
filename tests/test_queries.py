"""Every registered query agrees with its SQL, and none is planned badly."""

import os

import duckdb
import pytest

import checks
from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, table_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(checks.SQL)
    assert set(checks.QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Cartesian", "PythonUDF", "EvalPython", "ArrowEval"):
        assert word not in plan
    result = con.execute(oracle_sql()[name])
    want = table_of([d[0] for d in result.description], result.fetchall())
    assert table_of(df.columns, df.collect()) == want


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "Tabulador"
    assert df.count() > 0
