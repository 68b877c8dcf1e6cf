"""Every query over the smallest tables, against its SQL in another engine."""

import math
import os

import pytest

from aerolith.plans import audits, catalog, footage, formats, scenes, sites, surveys  # noqa: F401 (add their queries to the catalogue)

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    try:
        return f"{float(v):.9g}"
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "events", "lineitem", "nation", "region", "supplier", "customer", "orders", "part"):
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    rel = duck.sql(catalog.ORACLE_SQL[name])
    want = sorted(tuple(norm(dict(zip(rel.columns, r))[c]) for c in names) for r in rel.fetchall())
    assert sorted(rel.columns) == names
    assert sorted(tuple(norm(r[c]) for c in names) for r in df.collect()) == want
