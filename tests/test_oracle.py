"""Spark queries against their DuckDB oracle SQL on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from orderlens.plans.oracle import oracle_queries  # noqa: E402
from orderlens.plans.registry import all_queries  # noqa: E402
from tools.oracle_check import duck, rows_of  # noqa: E402

QUERIES = all_queries()
SQL = oracle_queries()
# Empty or zero by nature on the test tables: nothing.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1179
    assert df.columns == ["user_id", "order_date", "daily_revenue", "cumulative_ltv",
                          "daily_order_count", "cumulative_order_count"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf, con, name):
    st = QUERIES[name](spark, sf).toArrow()
    ot = con.sql(SQL[name]).to_arrow_table()
    sc, stypes, srows = rows_of(st)
    oc, otypes, orows = rows_of(ot)
    assert sc == oc
    assert stypes == otypes
    assert st.num_rows == ot.num_rows
    assert srows == orows
    assert st.num_rows > 0 or name in EMPTY
