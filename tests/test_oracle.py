"""Every registered query against its SQL text in DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, n, problems = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert not problems, problems
    assert n >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
