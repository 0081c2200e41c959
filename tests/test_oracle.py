"""Every registered query against its DuckDB oracle (rows + columns + value hash)."""

import pytest

import __spark_entry__ as E
from data_paths import SMALL
from oracle_harness import compare, duck

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SMALL, name, QUERIES[name], ORACLE[name], con)
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() >= 0
    assert df.columns


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 15
    assert df.columns == ["question", "n", "mean", "mode", "variance", "std_dev"]


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
