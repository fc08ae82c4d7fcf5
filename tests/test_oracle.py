"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from quarry.plans import cluster, recommend, text_queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = E.queries()
SQL = E.oracle_sql()
OWN = [*text_queries.QUERIES, *recommend.QUERIES, *cluster.QUERIES]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["n", "word"]
    assert 0 < len(df.collect()) <= 15


def test_every_query_has_a_callable_and_sql_keys_match():
    assert set(SQL) <= set(QUERIES)
    assert set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, QUERIES, SQL)
    assert r["cols_ok"] and r["hash_ok"], r
