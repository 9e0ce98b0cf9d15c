"""Each core query against its SQL on the smallest tables, all values compared, and the rest for rows."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from millrace import queries as core

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = core.queries(), core.oracle_sql()


def _plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    return round(v, 5) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v


def _rows(df):
    return sorted(repr([_plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    if name not in ORACLE:
        got.count()
        return
    want, got = duck.execute(ORACLE[name]).df(), got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
