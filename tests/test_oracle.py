"""Every registered query runs; those with SQL match DuckDB (the driver's gate,
here at sf0.001 to keep the suite quick)."""

import re

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
# The training-data queries are tested in tests/llm.
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "anomaly" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_against_oracle(spark, con, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF, con)
    assert res["status"] in ("OK", "rows-only"), res
    assert res["spark_rows"] > 0


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
