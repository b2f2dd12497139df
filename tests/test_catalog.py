"""Registered queries against DuckDB on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from caselume.plans.catalog import QUERIES

DATA = contract.SMOKE_DIR
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
# The comparison of all models takes minutes; it runs with CASELUME_FULL=1.
NAMES = [n for n in QUERIES if n != "model_compare" or os.environ.get("CASELUME_FULL")]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len([n for n in QUERIES if n not in contract.oracle_sql()]) <= 4


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, rows) == table(names, cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
def test_flagship_plan_reads_two_columns_once(spark):
    df = QUERIES["signals_prr_chi2"](spark, DATA)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan and "Python" not in plan
