"""Every registered query against its oracle SQL (DuckDB) on the smallest data;
queries without SQL must at least run and return a stable schema."""

import pytest

import __spark_entry__ as E
from vitals.oracle.compare import compare, duck_with_views

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    return duck_with_views(sf_small)


def test_contract_keys():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 90


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "exceso_mortalidad" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, sf_small, name):
    problems = compare(QUERIES[name](spark, sf_small), duck, ORACLE[name])
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    schema = df.schema
    assert df.count() > 0
    assert QUERIES[name](spark, sf_small).schema == schema
