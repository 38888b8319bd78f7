"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from oracle import queries_sql
from twinledger.plans import catalogue

QUERIES, SQL = catalogue.queries(), queries_sql.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_and_the_other_way_round():
    assert sorted(QUERIES) == sorted(SQL)
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck.sql(SQL[name])) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 2
