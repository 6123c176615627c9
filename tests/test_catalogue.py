"""The registered queries, and each against its SQL on the smallest data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lakesieve.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    got = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name in catalogue.oracle_sql():
        rel = duck.sql(catalogue.oracle_sql()[name])
        order = [rel.columns.index(c) for c in sorted(rel.columns)]
        assert sorted(df.columns) == sorted(rel.columns)
        assert got == sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
    else:
        assert got
