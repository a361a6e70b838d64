"""Every query runs on the smallest tables and, where SQL can say it, equals it; found queries have the columns asked for."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tamiz.llm import queries as q

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["task_id", "line_no"], "p2_found": ["issn"], "p3_found": ["task_id", "line_no"], "p4_found": ["task_id"], "p5_found": ["task_id"],
    "p6_found": ["tabla", "clave"], "p7_found": ["campo", "task_id", "line_no"], "p8_found": ["doc_id", "item_id"], "p9_found": ["source"], "p10_found": ["doc_id"],
}
TYPES = {"task_id": "bigint", "doc_id": "bigint", "item_id": "bigint", "line_no": "int"}


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
@pytest.mark.parametrize("name", list(q.queries()))
def test_query(spark, con, name):
    df = q.queries()[name](spark, SF)
    if name in COLUMNS:
        assert dict(df.dtypes) == {c: TYPES.get(c, "string") for c in COLUMNS[name]} and df.columns == COLUMNS[name]
    got = df.toPandas()
    if name in COLUMNS:
        assert not got.duplicated().any()
    if name in q.oracle_sql():
        assert plain(got) == plain(con.execute(q.oracle_sql()[name]).df())
