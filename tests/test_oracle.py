"""Every registered query against its DuckDB oracle (or a rows-only run)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, sf_dir, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
