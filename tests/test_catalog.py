"""Every catalogued query against its SQL on DuckDB, at the smallest scale."""

import math
import os

import pytest

from lakeloom.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert name in ORACLES
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = QUERIES[name](spark, DATA)
    got = con.execute(ORACLES[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, got.fetchall())
