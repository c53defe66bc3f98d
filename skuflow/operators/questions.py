"""The six business questions of the SQL layer.

Every aggregate runs on the fact grain first and only the (small) aggregated
result is decorated with dimension attributes.  Top-k results use
``orderBy(...).limit(k)`` with the key columns as tie-break, which Spark plans
as a per-partition top-k followed by a single k-row merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import dollars, exact, money_sum, pct, round_ratio, sort_bounded
from skuflow.sources.model import Model


def _warehouse_names(m: Model) -> DataFrame:
    return m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"), "region")


def order_revenue(m: Model) -> DataFrame:
    """J3 step 1: lines pre-aggregated to the order grain (fan-out safe)."""
    return m.order_lines.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("price_cents")).alias("order_revenue_cents"))


def warehouse_totals(m: Model) -> DataFrame:
    """C1 aggregate in exact cents (before presentation).

    Fan-out safe: lines are first reduced to one row per order (with the
    order's warehouse and status), then orders are counted per warehouse.
    Orders without lines do not appear in the line facts (the inner join).
    """
    per_order = m.facts.groupBy("order_id", "warehouse_id", "status").agg(
        F.sum(F.col("quantity") * F.col("price_cents")).alias("order_revenue_cents"))
    return per_order.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("order_revenue_cents")).alias("revenue_cents"),
        F.count_if(F.col("status") == "Returned").alias("returned"),
        F.count_if(F.col("status") == "Cancelled").alias("cancelled"),
    )


def warehouse_performance(m: Model) -> DataFrame:
    """Orders of every status; orders without lines drop out (inner join)."""
    return (
        warehouse_totals(m).join(_warehouse_names(m), "warehouse_id")
        .select(
            "warehouse_id", "warehouse_name", "region", "total_orders",
            dollars(F.col("revenue_cents")).alias("total_revenue"),
            round_ratio(F.col("revenue_cents"), exact(F.col("total_orders")) * 100, 2).alias("avg_order_value"),
            pct(F.col("returned"), F.col("total_orders")).alias("return_rate_pct"),
            pct(F.col("cancelled"), F.col("total_orders")).alias("cancellation_rate_pct"),
        )
    ).transform(lambda d: sort_bounded(d, F.desc("total_revenue"), "warehouse_id"))


def top_revenue_products(m: Model, limit: int = 20) -> DataFrame:
    """No status filter; margin at the product's current unit cost."""
    per_product = m.order_lines.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("orders_containing_product"),
        F.sum("quantity").alias("units_sold"),
        money_sum(F.col("quantity") * F.col("price_cents")).alias("revenue_cents"),
    )
    p = m.products.select("product_id", "sku", "category", "unit_cost_cents")
    # sum(q * (price - cost)) = sum(q * price) - cost * sum(q): cost is per product.
    return (
        per_product.join(p, "product_id")
        .select(
            "product_id", "sku", "category", "orders_containing_product", "units_sold",
            dollars(F.col("revenue_cents")).alias("total_revenue"),
            dollars(F.col("revenue_cents") - exact(F.col("unit_cost_cents")) * F.col("units_sold"))
            .alias("total_margin"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


def _below_reorder(m: Model) -> DataFrame:
    p = m.products.select("product_id", "sku", "category", "reorder_point", "safety_stock")
    return (
        m.inventory.join(p, "product_id")
        .filter(F.col("quantity_on_hand") < F.col("reorder_point"))
        .join(_warehouse_names(m).drop("region"), "warehouse_id")
    )


def stockout_risk(m: Model, limit: int = 50) -> DataFrame:
    """Positions below their reorder point, the lowest cover first."""
    return (
        _below_reorder(m)
        .select(
            "product_id", "sku", "category", "warehouse_name", "quantity_on_hand", "reorder_point",
            "safety_stock",
            pct(F.col("quantity_on_hand"), F.col("reorder_point"), 1).alias("pct_of_reorder_point"),
            "warehouse_id",
        )
        .orderBy(F.asc_nulls_first("pct_of_reorder_point"), "product_id", "warehouse_id")
        .limit(limit)
        .drop("warehouse_id")
    )


def supplier_reliability(m: Model, min_delivered: int = 5, limit: int = 20) -> DataFrame:
    """C4: in-transit POs count toward the total only; delay is signed."""
    po = m.purchase_orders
    delivered = F.col("actual_delivery_date").isNotNull()
    agg = po.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("total_purchase_orders"),
        F.count_if(delivered).alias("delivered_pos"),
        F.count_if(delivered & (F.col("actual_delivery_date") > F.col("expected_delivery_date"))).alias("late"),
        F.sum(F.datediff("actual_delivery_date", "expected_delivery_date")).alias("delay_sum"),
    ).filter(F.col("delivered_pos") >= min_delivered)
    s = m.suppliers.select("supplier_id", F.col("name").alias("supplier_name"), "region", "primary_category")
    return (
        agg.join(s, "supplier_id")
        .select(
            "supplier_id", "supplier_name", "region", "primary_category", "total_purchase_orders",
            "delivered_pos",
            pct(F.col("late"), F.col("delivered_pos")).alias("late_delivery_rate_pct"),
            round_ratio(F.col("delay_sum"), F.col("delivered_pos"), 2).alias("avg_delay_days"),
        )
        .orderBy(F.desc_nulls_last("late_delivery_rate_pct"), "supplier_id")
        .limit(limit)
    )


def dead_stock_value(m: Model, ratio: int = 4) -> DataFrame:
    """Stock-only dead stock (on hand >= ratio x safety stock), valued at cost."""
    p = m.products.select("product_id", "category", "safety_stock", "unit_cost_cents")
    return (
        m.inventory.join(p, "product_id")
        .filter(F.col("quantity_on_hand") >= F.col("safety_stock") * ratio)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("dead_stock_positions"),
            F.sum("quantity_on_hand").alias("total_units_tied_up"),
            money_sum(F.col("quantity_on_hand") * F.col("unit_cost_cents")).alias("value_cents"),
        )
        .select("category", "dead_stock_positions", "total_units_tied_up",
                dollars(F.col("value_cents")).alias("dead_stock_value"))
    ).transform(lambda d: sort_bounded(d, F.desc("dead_stock_value"), "category"))


def reorder_recommendations(m: Model, lookback_days: int = 30, limit: int = 50) -> DataFrame:
    """Per (warehouse, product) cover for safety stock + last N days of demand.

    "Today" is the latest order date of any status (a scalar subquery); the
    window includes today - N and demand is divided by N.
    """
    today = m.scalar("max_order_date")
    recent = (
        m.facts.filter(F.col("order_date") >= F.date_sub(today, lookback_days))
        .groupBy("warehouse_id", "product_id")
        .agg(F.sum("quantity").alias("units_recent"))
    )
    units = F.coalesce(F.col("units_recent"), F.lit(0)).cast("long")
    return (
        _below_reorder(m)
        .join(recent, ["warehouse_id", "product_id"], "left")
        .select(
            "product_id", "sku", "category", "warehouse_name", "quantity_on_hand", "reorder_point",
            "safety_stock",
            units.alias(f"units_sold_last_{lookback_days}_days"),
            round_ratio(units, F.lit(lookback_days), 2).alias("avg_daily_demand"),
            F.greatest(F.lit(0).cast("long"), F.col("safety_stock") + units - F.col("quantity_on_hand"))
            .alias("recommended_order_quantity"),
            "warehouse_id",
        )
        .orderBy(F.desc("recommended_order_quantity"), "product_id", "warehouse_id")
        .limit(limit)
        .drop("warehouse_id")
    )
