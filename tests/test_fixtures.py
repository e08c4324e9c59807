"""Fixture SQL gives identical rows in Spark SQL and DuckDB (both sides of
every oracle comparison read them)."""

import hashlib

import pytest

from elcorpus import fixtures as fx
from tests.conftest import SF_SMALL


def _digest(rows):
    return hashlib.md5("\n".join(sorted(repr(tuple(r)) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(fx.FIXTURES))
def test_fixture_same_in_both_engines(spark, duck, name):
    a = [tuple(r) for r in fx.fixture(spark, SF_SMALL, name).collect()]
    b = duck.execute(fx.FIXTURES[name]).fetchall()
    assert len(a) == len(b) and _digest(a) == _digest(b)


def test_fixtures_cover_every_document(spark):
    fx.register(spark, SF_SMALL)
    docs = spark.table("documents").count()
    originals = spark.table("wiki_pages").filter("input_seq < 1000000000").count()
    assert originals == docs
