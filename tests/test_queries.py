"""Every query against its SQL on the small tables."""

import collections
import os

import duckdb
import pytest

from pagewright.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = collections.Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in SQL:
        found = duck.execute(SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == collections.Counter(tuple(plain(r[k]) for k in at) for r in found.fetchall())
    else:
        assert rows
