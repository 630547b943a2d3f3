"""Every registered market query against its SQL, and its plan."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference, spark_table, sql_table
from tickloom.plans.oracle import SQL
from tickloom.plans.registry import QUERIES, ROWS_ONLY

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(k for k in QUERIES if not k.startswith("stream_") and k not in ROWS_ONLY)
STREAMS = sorted(k for k in QUERIES if k.startswith("stream_"))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    assert difference(spark_table(df), sql_table(con, SQL[name])) is None


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(spark_table(df), sql_table(con, SQL[name])) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 85
