"""Every registered query against its DuckDB statement, over whole tables."""

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from snapwright.plans.queries import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert got, "a check over no rows checks nothing"
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 999
