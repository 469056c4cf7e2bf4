"""Every registered query of the library against its SQL twin, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def plain(x):
    if isinstance(x, float):
        return round(x, 9)
    if isinstance(x, decimal.Decimal):
        return float(x)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(dict(zip(names, row))[c]) for c in columns]) for row in found.fetchall())
    assert got == want
