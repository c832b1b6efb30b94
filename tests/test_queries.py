"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import SF_DIR, duck_rows, spark_rows
from docstrata.workload.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name not in CHECKS:
        assert result.count() > 0
        return
    columns, rows = spark_rows(result)
    expected_columns, expected = duck_rows(duck, CHECKS[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_product_of_rows(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Window"):
        assert operator not in plan


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
