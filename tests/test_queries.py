"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__
import tidegate_queries
from tests.compare import spark_bag, sql_bag

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = tidegate_queries.QUERIES, tidegate_queries.ORACLES


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    columns, rows = spark_bag(QUERIES[name](spark, SF_DIR))
    expected_columns, expected_rows = sql_bag(SF_DIR, ORACLES[name])
    assert columns == expected_columns
    assert expected_rows, "the SQL gives no row to compare"
    assert sum(rows.values()) == sum(expected_rows.values())
    assert rows == expected_rows


def test_every_query_is_registered():
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLES.keys() <= __spark_entry__.oracle_sql().keys()


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
