"""Every registered query runs at sf0.001 and equals its DuckDB SQL."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from weft.oracle import sql as own_sql
from weft.registry import queries as own_queries

SF = "/root/testdata/sf0.001"
SLOW = {"model_metrics", "permutation_importance", "batch_score", "feature_importance", "model_search",
        "validation_curve", "model_shapley"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "degree"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(own_queries()) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert bag(df.columns, rows) == bag(rel.columns, rel.fetchall())


def test_every_query_has_oracle_or_is_model():
    missing = set(own_queries()) - set(own_sql())
    assert missing <= SLOW
