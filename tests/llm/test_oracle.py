"""Training-data queries whose results SQL can express, against DuckDB."""
import pytest

from metrolake.llm.queries import CATALOG
from tests.oracle_util import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in CATALOG.items() if sql])
def test_query_equals_its_sql(spark, name):
    fn, sql = CATALOG[name]
    ok, said = compare(fn(spark, SF), duck(SF), sql)
    assert ok, said
