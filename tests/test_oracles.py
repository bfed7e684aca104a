"""Every registered query against its SQL twin, on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tierlake.plans import queries as plan_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(plan_queries.QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


STEPS = sorted(plan_queries.QUERIES)


@pytest.mark.parametrize("name", STEPS)
def test_query_matches(spark, database, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    result = database.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    found = [tuple(row[c] for c in columns) for row in frame.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert found
