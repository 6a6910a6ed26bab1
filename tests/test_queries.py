"""Every registered query against its SQL in DuckDB."""

import os

import pytest
from compare import difference, duck

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of terrace.llm have their own tests.
QUERIES, ORACLE = contract.BASE_QUERIES, contract.BASE_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_id", "user_id", "window_id", "valid_to"]
    assert df.count() == 1000


def test_counts_read_no_column(spark):
    """Only the footers of the files are read: no column is in any scan."""
    plan = QUERIES["row_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == plan.count("FileScan parquet") > 10
