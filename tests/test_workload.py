"""Every registered query against its SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from martflow.workload.registry import QUERIES, SQL
from tools.compare import TABLES, rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_all_queries_have_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    df = entry.queries()[name](spark, SMALL)
    names, found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(entry.oracle_sql()[name])
    expected_names, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == expected_names
    assert found == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
