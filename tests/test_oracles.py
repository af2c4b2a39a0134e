"""Every registered query of the package against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from parlance import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables aren't here")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    assert rows or name == "q_vad_groups"
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    got = duck.execute(sql)
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted((tuple(plain(dict(zip(cols, r, strict=True))[c]) for c in order) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr) == want
