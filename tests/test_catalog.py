"""Every registered query that SQL can express, held against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from planweave.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(name, spark, data, duck):
    got = catalog.QUERIES[name](spark, data)
    r = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(plain(row[names.index(c)]) for c in got.columns) for row in r.fetchall())
    assert sorted(tuple(plain(v) for v in row) for row in got.collect()) == want


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
