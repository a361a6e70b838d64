"""Every query runs on the smallest tables and equals its SQL."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(df):
    def cell(v):
        if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in entry.queries() if not n[1:2].isdigit()])
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql:
        want = con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
