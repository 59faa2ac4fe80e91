from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from trackloom.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    return c


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 9) + 0.0) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    found = duck.execute(SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
