"""Every query next to its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from trendloom.plans.oracle import ORACLE_SQL
from trendloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, database, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), database, ORACLE_SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["rank", "cluster_id"]
