"""Every pN_ query with SQL against it in DuckDB, on the smallest test tables."""

import os

import pytest
from test_catalog import DATA, duck, rows  # noqa: F401

from tesselex.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, duck, name):  # noqa: F811
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), duck.sql(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_sql_has_a_query():
    assert set(queries.SQL) <= set(queries.QUERIES)
