"""Every query with SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pytest

from quirework.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    assert got[1] or name.startswith(("tb5", "fg9"))
    if name in ORACLE:
        found = duck.execute(ORACLE[name])
        assert got == rows([d[0] for d in found.description], found.fetchall())
