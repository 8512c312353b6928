"""Every registered query equals its SQL oracle (DuckDB) on the small tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
#: queries of the optional part, some of which SQL cannot express; that part's own tests hold them to brute force
OPTIONAL = set(entry.TEXT_QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) <= OPTIONAL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "is_current" in df.columns
