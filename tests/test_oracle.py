"""Every registered query against its SQL counterpart, on the smallest tables or ``ORACLE_SF_DIR``."""

import os

import pytest

import __spark_entry__ as registry
from tests import compare

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
WITHOUT_ORACLE = {"perturbed_salaries"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry._QUERIES) - set(registry.ORACLES) == WITHOUT_ORACLE
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, oracle, name):
    columns, rows = compare.spark_rows(registry.queries()[name](spark, SF_DIR))
    expected_columns, expected = compare.oracle_rows(oracle, registry.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [
    "q1_dept_budget", "q2_manager_workload", "q3_vendor_concentration", "q4_open_issues", "q5_monthly_spend",
    "q6_salary_increases", "pending_above_avg", "pending_naive", "kpi", "fact_asof_employee", "transactions_enriched",
])
def test_no_cartesian_products(spark, name):
    plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = registry.queries()["q4_open_issues"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "In(payment_status, [Disputed,Pending])" in plan
    assert "ReadSchema: struct<project_key:bigint,amount:decimal(15,2),payment_status:string>" in plan
