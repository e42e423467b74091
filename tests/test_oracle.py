"""Every registered query against its SQL in DuckDB."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(expected)
    assert rows_of(df.columns, got) == rows_of(names, expected)


def test_flagship_query_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["x", "y", "z"]
    assert df.count() == 50


@pytest.mark.parametrize("name", ["hot_cells_ranked", "hot_cells_top50"])
def test_ranking_order(spark, duck, name):
    got = [tuple(r) for r in QUERIES[name](spark, SF_DIR).collect()]
    assert got == duck.execute(ORACLE[name]).fetchall()
