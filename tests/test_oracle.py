"""Every registered query against its DuckDB reference SQL on the sf0.001 test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from fleetvolt.plans import oracle as O
from fleetvolt.plans import registry as R

SF = "/root/testdata/sf0.001"
NAMES = sorted(R.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "customer", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "isoformat"):
        return str(v)[:26] if ":" in str(v) else str(v)[:10]
    if isinstance(v, float):
        return repr(v)
    return str(v)


def test_every_query_has_sql():
    assert set(NAMES) == set(O.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=str)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=str)
    assert got == want
