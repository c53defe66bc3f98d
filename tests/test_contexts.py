"""Many contexts from one scan equal one context at a time; distinct counts merge exactly."""

import re

import pytest
from pyspark.sql import functions as F

from skuflow.plans import contexts, measures
from tests.frames import WAREHOUSES, D, make_model, product, supplier


def plain(row, names):
    return tuple(None if row[n] is None else round(row[n], 9) for n in names)


def test_each_context_equals_its_own_evaluation(model):
    rows = contexts.line_measures(model, contexts.STANDARD).collect()
    for by in contexts.STANDARD:
        own = {tuple(r[k] for k in by): plain(r, contexts.LINE_MEASURES) for r in measures.evaluate(model, contexts.LINE_MEASURES, by).collect()}
        got = {tuple(r[k] for k in by): plain(r, contexts.LINE_MEASURES) for r in rows if r["context"] == ",".join(by)}
        assert got == own, by
    assert {r["context"] for r in rows} == {",".join(c) for c in contexts.STANDARD}


def test_the_facts_are_read_once(model):
    contexts.line_measures(model, [()])                                   # ranks the revenue once, for abc_class
    plan = contexts.line_measures(model, contexts.STANDARD)._jdf.queryExecution().executedPlan().toString()
    reads = [x for x in re.findall(r"FileScan parquet \[[^\]]*\]", plan) if "price_cents" in x]
    assert len(reads) == 1


def test_order_counts_of_all_subtotals(model):
    keys = ("warehouse_name", "category")
    lines = measures.family_frame(model, "sales_all", set(keys))
    own = lines.cube(*keys).agg(F.grouping("warehouse_name").alias("a"), F.grouping("category").alias("b"), F.countDistinct("order_id").alias("orders"),
                                F.countDistinct(F.when(F.col("status") == "Delivered", F.col("order_id"))).alias("d"),
                                F.countDistinct(F.when(F.col("status") == "Returned", F.col("order_id"))).alias("r"))
    got = {tuple(r) for r in contexts.order_counts(model, keys).select(*keys, "all_warehouse_name", "all_category", "orders", "delivered_orders", "returned_orders").collect()}
    assert got == {tuple(r) for r in own.select(*keys, "a", "b", "orders", "d", "r").collect()}


@pytest.fixture(scope="module")
def spread(spark):
    """Order ids far apart, negative ones too, each with lines of several products."""
    ids = [1, 2, 32767, 32768, 32769, 10 ** 12, 10 ** 12 + 1, -5]
    orders = [(i, D(2024, 1 + k % 3, 1), 1 + k % 2, 7, ("Delivered", "Returned", "Cancelled")[k % 3]) for k, i in enumerate(ids)]
    lines = [(10 * k + j, i, 1 + (k + j) % 3, 1, 100) for k, i in enumerate(ids) for j in range(3)]
    return make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=[product(p, "ab"[p % 2]) for p in (1, 2)], orders=orders, order_lines=lines)


def test_ids_far_apart_and_a_blank_member(spread):
    for by in (("category",), ("warehouse_name", "year_month"), ()):
        own = {tuple(r[k] for k in by): plain(r, contexts.LINE_MEASURES) for r in measures.evaluate(spread, contexts.LINE_MEASURES, by).collect()}
        got = {tuple(r[k] for k in by): plain(r, contexts.LINE_MEASURES) for r in contexts.line_measures(spread, [by]).collect()}
        assert got == own
    assert None in {r["category"] for r in contexts.line_measures(spread, [("category",)]).collect()}


def test_sketches_come_near(model):
    exact = {r["warehouse_name"]: r["order_count"] for r in contexts.line_measures(model, [("warehouse_name",)]).collect()}
    near = {r["warehouse_name"]: r["order_count"] for r in contexts.line_measures(model, [("warehouse_name",)], approximate=True).collect()}
    assert near.keys() == exact.keys() and all(abs(near[k] - exact[k]) <= 0.1 * exact[k] + 2 for k in exact)
    total = contexts.order_counts(model, ("category",), approximate=True).where("all_category = 1").first()["orders"]
    assert abs(total - model.facts.select("order_id").distinct().count()) <= 0.1 * total


def test_unbounded_or_unrelated_keys(model):
    for key in ("product_id", "date_key", "risk_tier"):
        with pytest.raises(ValueError, match="one scan"):
            contexts.line_measures(model, [(key,)])
