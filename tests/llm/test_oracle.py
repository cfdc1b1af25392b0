"""Queries with SQL against DuckDB; all queries give rows of a stable schema."""

import pytest

from flowlens.llm.queries import QUERIES, SQL
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert compare(spark, name, QUERIES[name], SQL[name], SF, duck(SF))["status"] == "OK"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
