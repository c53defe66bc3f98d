"""Plan shape: no Python UDFs, no cartesian products, filters reach the scan."""

import re

import pytest

from skuflow import registry

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct")


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_no_python_udf_or_cartesian(built, key):
    plan = built(key)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, (key, bad)


def test_status_filter_pushed_to_scan(spark, model):
    from skuflow.operators.abc import product_sales
    plan = product_sales(model)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,Delivered)" in plan


def scans(df, column):
    """How many scans of the plan read a column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(column in x for x in re.findall(r"FileScan parquet \[[^\]]*\]", plan))


def test_star_checks_read_each_fact_once(model):
    from skuflow.plans import star
    checks = star.validated_checks(model)
    assert scans(checks, "status") == 1                                   # the sales fact
    assert scans(checks, "ship_date") == 1                                # purchase orders
    assert scans(checks, "price_cents") == scans(checks, "quantity_on_hand") == 0     # no ranking, positions by key only


def test_a_measure_by_category_needs_no_product_join(model):
    from skuflow.plans import measures
    plan = measures.evaluate(model, ["total_revenue", "order_count"], ["category"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
