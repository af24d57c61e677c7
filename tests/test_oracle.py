"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect

# The optional subpackage has tests of its own.
QUERIES = {k: q for k, q in contract.queries().items() if k not in contract.LLM_QUERIES}
SQL = {k: q for k, q in contract.oracle_sql().items() if k not in contract.LLM_SQL}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    rows, differences = compare(QUERIES[name](spark, SF_DIR), duck, SQL[name])
    assert not differences and rows > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 219 and df.count() > 0
