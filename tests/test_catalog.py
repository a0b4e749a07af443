"""Every registered query that has SQL, against DuckDB on the smallest tables, and its physical plan."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_point

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return con


def plain(frame):
    def value(v):
        if pd.isna(v):
            return "NULL"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, np.integer, float, np.floating)):
            return repr(float(v))
        return str(v)
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(value, row)) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, tiny, name):
    made = QUERIES[name](spark, tiny)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plain(made.toPandas()) == plain(duck.sql(SQL[name]).df())


def test_registry():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) >= 120


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
