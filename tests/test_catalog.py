"""Every query of the catalog against its SQL in DuckDB, on the smallest test tables."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from tesselex.plans import catalog, io_queries  # noqa: F401 - registers its queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def flat(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return str([flat(x) for x in v])
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return str(int(v)) if float(v).is_integer() else repr(round(float(v), 6))
    return str(v)


def rows(df):
    return sorted(repr(tuple(flat(v) for v in r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) or name in ("repeated_lines", "chunk_caps_truncation_log", "suspect_pages", "missing_files")
    assert rows(got) == rows(want)


def test_names_without_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
