"""Every registered query against its SQL counterpart, on whole tables."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()
# Checks that hold return no row.
MAY_BE_EMPTY = {"reconcile_orders", "reconcile_order_items", "assert_history_current", "review_filter", "status_changes",
                "dq_relationships", "anomaly_days", "review_eligibility", "texts_to_embed"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("op") and n != "pipeline"))
def test_query_equals_sql(spark, con, name):
    problems = compare(QUERIES[name](spark, SF_DIR), con, SQL[name])
    if name in MAY_BE_EMPTY and problems == ["EMPTY"]:
        return
    assert not problems, "\n".join(problems)


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
    assert {name for name in QUERIES.keys() - SQL.keys() if not name.startswith("op") and name != "pipeline"} == set()


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
