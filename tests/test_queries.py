"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert compare(duck, df, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
