"""Differential test: every registered query against its DuckDB oracle on
the sf0.001 tables (row count + order-insensitive values)."""

import hashlib

import pytest


from elcorpus import registry as R
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(R.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = R.QUERIES[name](spark, SF_SMALL)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(R.ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = _digest(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(R.QUERIES) == set(R.ORACLES)
