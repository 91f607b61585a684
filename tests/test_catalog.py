"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from siftwise.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(FOLDER):
        c.execute(f"create view {t[:-8]} as select * from read_parquet('{FOLDER}/{t}')")
    return c


def cell(x):
    if isinstance(x, (list, np.ndarray)):
        return str([cell(y) for y in x])
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
        return None
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    return f"{x:.9g}" if isinstance(x, (float, np.floating)) else str(x)


def rows(frame):
    return sorted((tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    assert len(set(got.columns)) == len(got.columns)
    got = got.toPandas()
    if name in SQL:
        want = duck.execute(SQL[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
