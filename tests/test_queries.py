"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clicktally.plans.expected import EXPECTED
from clicktally.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    result = queries()[name](spark, SF_DIR)
    expected = tables.execute(oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = _sorted_rows(result.columns, result.collect())
    wanted = _sorted_rows(columns, expected.fetchall())
    assert wanted
    assert found == wanted


def test_every_query_has_sql():
    assert QUERIES.keys() == EXPECTED.keys()
    assert queries().keys() >= oracle_sql().keys()


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
