"""Every registered query against its DuckDB oracle (sf0.001): same columns, rows and values."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from skuflow import registry
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem".split()
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, (int, float)):
        return (2, float(v))
    return (4, str(v))


def test_every_query_has_an_oracle():
    missing = sorted(set(registry.queries()) - set(registry.oracle_sql()))
    assert missing == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_same_column_types(built, con, key):
    sdf = built(key)
    mine = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in sdf.schema.fields}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {registry.oracle_sql()[key]}").fetchall()}
    assert mine == theirs


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(built, con, key):
    sdf = built(key)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(registry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if x[0] == 2 and y[0] == 2:
                assert math.isclose(x[1], y[1], rel_tol=1e-12, abs_tol=1e-12), (key, a, b)
            else:
                assert x == y, (key, a, b)
