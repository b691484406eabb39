"""Every registered query of the medallion library against its SQL twin in DuckDB."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from tellerline.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = _sorted_by_name(names, cursor.fetchall())
    actual = _sorted_by_name(result.columns, [tuple(r) for r in result.collect()])
    assert expected[1], "the query must return rows"
    assert actual == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
