"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from trendlake import oracle, registry
from tests.compare import spark_result, sql_result
from tests.conftest import SF_DIR

QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.SQL)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, name):
    assert spark_result(QUERIES[name](spark, SF_DIR)) == sql_result(SF_DIR, SQL[name])


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
