"""Every registered query of the archive engine against its SQL at the smallest scale."""

import glob
import math
import os

import duckdb
import pytest

from pulsevault.plans import registry

from .conftest import SF

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(SQL[name])
    want = rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want, strict=True):
        assert a == b
