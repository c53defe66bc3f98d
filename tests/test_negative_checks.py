"""Every data-quality check fails on a model that breaks its rule, and only there."""

import pytest
from pyspark.sql import functions as F

from skuflow.operators import quality
from skuflow.plans import star
from tests.frames import WAREHOUSES, D, make_model, product, supplier

ROWS = {
    "warehouses": WAREHOUSES, "suppliers": [supplier(1)], "products": [product(1), product(2)],
    "inventory": [(1, 1, 5, D(2024, 1, 1)), (1, 2, 30, D(2024, 1, 1))],
    "purchase_orders": [(1, 1, 1, D(2024, 1, 2), D(2024, 1, 9), D(2024, 1, 8), 5), (2, 1, 2, D(2024, 1, 2), D(2024, 1, 9), None, 5)],
    "orders": [(1, D(2024, 1, 3), 1, 7, "Delivered"), (2, D(2024, 2, 3), 2, 7, "Returned")], "order_lines": [(1, 1, 1, 2, 150), (2, 2, 2, 1, 150)],
}
W = ("2024-01-01", "2024-12-31")


def loose(spark, **changes):
    """The rows above with replaced tables; schemas without NOT NULL, so that anything goes in."""
    m = make_model(spark, **{k: v for k, v in ROWS.items() if k not in changes})
    frames = {}
    for name, rows in changes.items():
        schema = m.table(name).schema
        for f in schema.fields:
            f.nullable = True
        frames[name] = spark.createDataFrame(rows, schema)
    return m.replace(**frames) if frames else m


def failed(df):
    return {r["check"] for r in df.collect() if not r["passed"]}


CASES = [
    (quality.pk_checks, {"orders": ROWS["orders"] + [ROWS["orders"][0]]}, {"orders(order_id) is unique"}),
    (quality.pk_checks, {"products": [product(1), (2, "SKU-1", "cat", 100, 200, 1, 10, 5, None)]}, {"products(sku) is unique"}),
    (quality.pk_checks, {"inventory": ROWS["inventory"] + [(1, None, 1, D(2024, 1, 1))]}, {"inventory(warehouse_id, product_id) is unique"}),
    (quality.not_null_checks, {"order_lines": [(1, 1, None, 2, 150)]}, {"order_lines.product_id is not null"}),
    (quality.check_constraints, {"warehouses": [(1, "N", "N", 0)]}, {"warehouses: capacity_units > 0"}),
    (quality.check_constraints, {"products": [product(1, cost=300)]}, {"products: unit_price >= unit_cost"}),
    (quality.check_constraints, {"inventory": [(1, 1, -1, D(2024, 1, 1))]}, {"inventory: quantity_on_hand >= 0"}),
    (quality.check_constraints, {"suppliers": [(1, "S", "N", "c", 1.5, 0)]}, {"suppliers: base_reliability_score between 0 and 1", "suppliers: avg_lead_time_days > 0"}),
    (quality.domain_checks, {"orders": [(1, D(2024, 1, 3), 1, 7, "Lost")]}, {"orders.status in domain"}),
    (quality.domain_checks, {"orders": [(1, D(2024, 1, 3), 1, 7, None)]}, {"orders.status in domain"}),
    (quality.fk_checks, {"order_lines": [(1, 9, 8, 2, 150)]}, {"order_lines.order_id references orders", "order_lines.product_id references products"}),
    (quality.fk_checks, {"orders": [(1, D(2024, 1, 3), 5, 7, "Delivered"), (2, D(2024, 1, 3), 1, 7, "Delivered")]}, {"orders.warehouse_id references warehouses"}),
    (lambda m: quality.date_window_check(m, *W), {"orders": [(1, D(2025, 1, 1), 1, 7, "Delivered")]}, {"orders dated inside the expected window"}),
    (quality.po_date_check, {"purchase_orders": [(1, 1, 1, D(2024, 1, 2), D(2024, 1, 9), D(2024, 1, 1), 5)]}, {"delivered POs arrive on or after the order date"}),
    (lambda m: quality.row_count_checks(m, {"orders": F.lit(2)}), {"orders": ROWS["orders"][:1]}, None),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_a_broken_rule_is_reported(spark, number):
    check, change, names = CASES[number]
    assert failed(check(loose(spark))) == set()
    found = failed(check(loose(spark, **change)))
    assert found == names if names else len(found) == 1


def test_shares_and_reconciliation(spark):
    m = loose(spark)
    late = loose(spark, purchase_orders=[(i, 1, 1, D(2024, 1, 2), D(2024, 1, 9), D(2024, 1, 12), 5) for i in range(4)])
    assert failed(quality.on_time_share(late)) and not failed(quality.on_time_share(m, (1.0, 1.0)))
    assert failed(quality.stockout_share(m)) and failed(quality.dead_share(m))
    assert not failed(quality.revenue_reconcile(m)) and not failed(quality.dead_reconcile(m))
    assert failed(quality.revenue_reconcile(loose(spark, order_lines=ROWS["order_lines"] + [(3, 99, 1, 1, 10)])))


def test_star_checks_fail_where_a_dimension_lacks_a_key(spark):
    broken = loose(spark, products=[product(1)])
    names = failed(star.validated_checks(broken))
    assert names == {"fact_sales.product_id resolves", "fact_inventory.product_id resolves", "fact_purchase_orders.product_id resolves"} - (
        set() if 2 in {r["product_id"] for r in star.fact_sales(broken).collect()} else {"fact_sales.product_id resolves"})
    assert failed(star.validated_checks(loose(spark))) == set()
    assert failed(star.validated_checks(loose(spark, warehouses=[*WAREHOUSES, WAREHOUSES[0]]))) == {"dim_warehouse.warehouse_id is unique"}


def test_verdict_reads_every_check(spark):
    bad = quality.verdict(quality.check_constraints(loose(spark, inventory=[(1, 1, -1, D(2024, 1, 1))]))).first()
    assert not bad["all_passed"] and bad["failed_checks"] == 1
