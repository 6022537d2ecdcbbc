"""Queries of the subpackage that SQL can express equal DuckDB on the same tables."""

import pytest

from attrition.llm.queries import QUERIES, SQL
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, SF, name, QUERIES[name], SQL[name], duck(SF))
    assert ok, msg
