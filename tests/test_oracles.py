"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, data, tables, key):
    result = QUERIES[key](spark, data)
    columns = sorted(result.columns)
    got = sorted(repr([row[c] for c in columns]) for row in result.collect())
    cursor = tables.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr([row[p] for p in places]) for row in cursor.fetchall())


def test_flagship(spark):
    assert entry_points.entry(spark).count() == 5
