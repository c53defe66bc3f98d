"""The data behind each BI page and dashboard chart (not the drawing).

Every feed is a small result of the operators and measures above; the only
full-length feed is the below-reorder list (a table visual), which stays a
distributed, sorted DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, money_sum, round_half_even, sort_bounded
from skuflow.operators import abc, deadstock, scorecard
from skuflow.operators.detail import line_facts
from skuflow.plans.measures import evaluate
from skuflow.sources.model import Model

# Fixed values of the dashboard.
HEALTH_ORDER = ("Healthy", "Overstocked", "Slow-Moving", "Dead")
PARETO_POINTS = 60
PARETO_THRESHOLDS = (80, 95)


def feed_exec_kpis(m: Model) -> DataFrame:
    """B1 KPI cards: revenue, margin %, inventory value, stockout %, high-risk suppliers."""
    return evaluate(m, ["total_revenue", "margin_pct", "inventory_value", "stockout_risk_pct",
                        "high_risk_suppliers"])


def feed_revenue_by_category(m: Model) -> DataFrame:
    """B1 revenue by category."""
    return sort_bounded(evaluate(m, ["total_revenue"], ["category"]), F.desc("total_revenue"), "category")


def feed_warehouse_matrix(m: Model) -> DataFrame:
    """Warehouse x category revenue with row, column and grand totals (CUBE)."""
    p = m.products.select("product_id", "category")
    w = m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"))
    # lines are summed per (warehouse, product), then per cell, before the cube makes four rows of each
    cells = (line_facts(m).groupBy("warehouse_id", "product_id").agg(money_sum(F.col("line_revenue_cents")).alias("c"))
             .join(p, "product_id").join(w, "warehouse_id")
             .groupBy("warehouse_name", "category").agg(F.sum("c").alias("c")))
    return (cells.cube("warehouse_name", "category")
            .agg(F.sum("c").alias("rev_c"), F.grouping_id().alias("grouping_level"))
            .select("warehouse_name", "category", (F.col("rev_c").cast("double") / 100).alias("revenue"),
                    "grouping_level")
            .transform(lambda d: sort_bounded(d, "grouping_level", "warehouse_name", "category")))


def feed_inventory_by_class(m: Model) -> DataFrame:
    """B3 inventory value and dead stock by ABC class."""
    return sort_bounded(evaluate(m, ["inventory_value", "dead_stock_value", "units_on_hand"], ["abc_class"]),
                        "abc_class")


def feed_turnover_vs_value(m: Model) -> DataFrame:
    """B3 turnover (raw, M22) against inventory value per category."""
    return sort_bounded(evaluate(m, ["inventory_turnover", "inventory_value"], ["category"]), "category")


def feed_below_reorder(m: Model) -> DataFrame:
    """B3 below-reorder list, lowest stock first (full list, a table visual)."""
    p = m.products.select("product_id", "sku", "category", "reorder_point")
    w = m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"))
    return (m.inventory.join(p, "product_id").filter(F.col("quantity_on_hand") < F.col("reorder_point"))
            .join(w, "warehouse_id")
            .select("product_id", "sku", "category", "warehouse_id", "warehouse_name", "quantity_on_hand",
                    "reorder_point")
            .orderBy("quantity_on_hand", "product_id", "warehouse_id"))


def feed_late_rate_monthly(m: Model) -> DataFrame:
    """B4 late-delivery rate by PO month."""
    return sort_bounded(evaluate(m, ["late_delivery_rate", "delivered_pos", "late_pos"], ["year_month"]),
                        "year_month")


def pareto_curve(m: Model, points: int = PARETO_POINTS) -> DataFrame:
    """Every k-th point of the ABC curve, k = max(1, n // points)."""
    c = abc.classify_cents(m)
    k = F.greatest(F.lit(1).cast("long"), (F.col("n_classified") - F.pmod(F.col("n_classified"), F.lit(points)))
                   / F.lit(points)).cast("long")
    share = F.col("cum_cents").cast("double") / F.col("total_cents").cast("double")
    return (c.filter(F.pmod(F.col("rank") - 1, k) == 0)
            .select("rank",
                    round_half_even((F.col("rank") * 100).cast("double") / F.col("n_classified").cast("double"), 2)
                    .alias("sku_pct"),
                    round_half_even(F.lit(100.0) * share, 2).alias("cum_revenue_pct"))
            .orderBy("rank"))


def pareto_crossing(m: Model, thresholds=PARETO_THRESHOLDS) -> DataFrame:
    """Share of SKUs at which cumulative revenue first reaches each threshold."""
    c = abc.classify_cents(m)
    rows = [c.filter(F.col("cum_cents") * F.lit(100).cast(EXACT) >= F.col("total_cents") * F.lit(t).cast(EXACT))
             .agg(F.min("rank").alias("rank"), F.max("n_classified").alias("n"))
             .select(F.lit(t).alias("threshold_pct"), "rank",
                     round_half_even((F.col("rank") * 100).cast("double") / F.col("n").cast("double"), 2)
                     .alias("sku_pct"))
            for t in thresholds]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return sort_bounded(out, "threshold_pct")


def stock_health_mix(m: Model) -> DataFrame:
    """C10 summary in the fixed display order, absent statuses dropped."""
    order = F.lit(None).cast("int")
    for i, s in reversed(list(enumerate(HEALTH_ORDER))):
        order = F.when(F.col("stock_status") == s, F.lit(i)).otherwise(order)
    return (deadstock.dead_stock_summary(m).withColumn("display_order", order)
            .filter(F.col("display_order").isNotNull()).transform(lambda d: sort_bounded(d, "display_order")))


def dashboard_top_products(m: Model, n: int = 10) -> DataFrame:
    """B7 top products by Delivered revenue (the ABC ranking's head)."""
    return (abc.classify_abc(m).filter(F.col("rank") <= n)
            .select("rank", "sku", "category", "units_sold", "total_revenue").orderBy("rank"))


def dashboard_bottom_suppliers(m: Model, n: int = 15) -> DataFrame:
    """B7 / T6 the n lowest composite scores."""
    return (scorecard.supplier_scorecard(m)
            .select("supplier_id", "supplier_name", "composite_score", "risk_tier", "late_delivery_rate_pct")
            .orderBy("composite_score", "supplier_id").limit(n))
