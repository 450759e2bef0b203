"""The catalog against its SQL on the smallest tables."""

import pytest
from check_queries import compare, connect

import __spark_entry__ as contract
from pagelode.catalog import queries as catalog

# The training-data queries are compared in tests/llm.
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_sql_keys_are_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(NAMES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, small, name):
    outcome = compare(spark, con, small, name, contract.oracle_sql().get(name))
    assert outcome.startswith(("ok", "rows=")), outcome
