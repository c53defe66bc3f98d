"""The load and the queries over it move each line as rarely as they can, and tasks do not grow with the input."""

import datetime

import pytest

from skuflow.plans import contexts
from skuflow.session import ROWS_PER_TASK, dealt, shuffle_width, shuffles_for
from skuflow.sources import tpch

DAY = datetime.datetime(2024, 1, 5)


@pytest.fixture(scope="module")
def src(spark):
    part = [(1, "a", 10.0), (1, "b", 20.0), (2, "a", 10.0)]
    line = [(7, p, 1, n, 2.0, 30.0, 0.0, 0.0, DAY) for n, p in ((1, 1), (1, 1), (2, 2), (3, 9))]
    return {"lineitem": spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                                              " l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"),
            "part": spark.createDataFrame(part, "p_partkey long, p_type string, p_retailprice double")}


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(7, DAY.date(), 1, 3, "Delivered")], "order_id long, order_date date, warehouse_id long, customer_id long, status string")


def test_a_repeated_product_repeats_the_line_under_its_id(src, orders):
    got = sorted((r["line_id"] - 7 * tpch.LINES_PER_ORDER, r["product_id"], r["product_category"] or "") for r in tpch._wide_lines(src, orders).collect())
    assert got == [(1, 1, "a"), (1, 1, "b"), (2, 1, "a"), (2, 1, "b"), (3, 2, "a"), (4, 9, "")]


def test_lines_are_dealt_by_order_once(spark, src, orders):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tpch._wide_lines(src, orders)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange hashpartitioning(order_id") == 2           # the lines and the orders
    assert plan.count("Exchange hashpartitioning(") == 4                   # lines and parts by product


def test_no_aggregate_of_the_contexts_sorts_lines(model):
    contexts.line_measures(model, [()])
    plan = contexts.line_measures(model, contexts.STANDARD)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" not in plan and "SortAggregate" not in plan


def test_shuffles_widen_with_the_rows(spark):
    key = "spark.sql.shuffle.partitions"
    configured = int(spark.conf.get(key))
    rows = ROWS_PER_TASK * configured + 1
    assert shuffle_width(spark, 5) == configured and shuffle_width(spark, rows) == configured + 1
    with shuffles_for(spark, rows):
        assert int(spark.conf.get(key)) == configured + 1
    assert int(spark.conf.get(key)) == configured
    assert dealt(spark.range(3), rows, "id").rdd.getNumPartitions() == configured + 1
