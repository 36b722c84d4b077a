"""Every query with SQL against DuckDB, and the others for rows, on the smallest tables."""

import os

import duckdb
import pytest

from strandlake.plans import cohort_queries, more_queries  # noqa: F401  registers their queries
from strandlake.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    sql = duck.sql(ORACLES[name])
    assert sorted(sql.columns) == sorted(df.columns)
    want = sql.project(", ".join(f'"{c}"' for c in df.columns)).fetchall()
    assert sorted(tuple(map(plain, r)) for r in rows) == sorted(tuple(map(plain, r)) for r in want)
