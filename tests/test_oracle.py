"""Every registered query against its SQL over the same tables."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from tidewise.plans.oracle import ORACLE
from tidewise.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_flagship_runs(spark):
    assert entry.entry(spark).columns == ["hr", "n"]
