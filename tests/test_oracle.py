"""Every registered query equals its DuckDB oracle, at sf0.001."""
import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from metrolake.plans.catalog import CATALOG
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck

QUERIES = {name: fn for name, (fn, _sql) in CATALOG.items()}
SQL = {name: sql for name, (_fn, sql) in CATALOG.items() if sql is not None}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, f"{name}: {msg}"
