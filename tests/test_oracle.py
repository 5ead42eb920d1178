"""Every registered query with checking SQL, on the smallest test files."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.catalogue import checking_sql, registered_queries
from checks.compare import TABLES, _rows

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_checking_sql():
    """Those of the corpus operators may have none; their own tests compare them."""
    assert set(registered_queries()) == set(checking_sql())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(SQL[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _rows(frame.columns, [tuple(row) for row in frame.collect()]) == _rows(
        columns, cursor.fetchall()
    )


def test_entry(spark):
    assert len(entry.entry(spark).collect()) == 15
