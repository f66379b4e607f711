"""Every registered query that has SQL must give the same rows on the second engine."""

import pytest
from compare import compare, duck

from kithscope.plans.registry import all_queries, all_sql
from tests.conftest import SMALL

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    compare(QUERIES[name](spark, SMALL), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns and df.count() > 0
