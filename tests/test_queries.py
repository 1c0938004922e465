"""Every query with SQL, against DuckDB, on the smallest tables."""
import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
SLOW = {"l1_text_classifier", "l2_multilabel_classifier", "l3_incremental_update",
        "l4_evaluate_and_decide", "i10_daily_run"}


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL) - SLOW))
def test_query_without_sql_gives_rows(spark, name):
    assert not entry.queries()[name](spark, DIR).isEmpty()


def test_flagship(spark):
    assert set(entry.entry(spark).columns) == {"label", "importance", "n", "pct"}
