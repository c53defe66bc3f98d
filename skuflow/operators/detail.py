"""The two enriched wide views most operators start from.

Lines are joined to their order header on ``order_id`` (the one fact-to-fact
join, sort-merge on both sides at scale, AQE splits skewed keys); product and
warehouse attributes are looked up afterwards.  Product is a large dimension
at scale, so no broadcast is forced: Spark broadcasts it when its measured
size allows and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import dollars
from skuflow.sources.model import Model


def line_facts(m: Model, statuses: tuple[str, ...] | None = ("Delivered",)) -> DataFrame:
    """Order lines with their header (and integer-cent measures), optionally status-filtered.

    Reads the staged line facts (the lines-orders join done once at load), so
    the status filter is pushed into the Parquet scan; lazily it is applied to
    the header before the join.
    """
    f = m.facts
    if statuses is not None:
        f = f.filter(F.col("status").isin(*statuses))
    return f.withColumn("line_revenue_cents", F.col("quantity") * F.col("price_cents"))


def sales_cents(m: Model, statuses: tuple[str, ...] | None = ("Delivered",)) -> DataFrame:
    """sales_detail with money in integer cents (internal form)."""
    p = m.products.select("product_id", "sku", "category", "supplier_id")
    w = m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"),
                            F.col("region").alias("warehouse_region"))
    return (
        line_facts(m, statuses)
        .join(p, "product_id")
        .join(w, "warehouse_id")
        .withColumn("line_cogs_cents", F.col("quantity") * F.col("unit_cost_cents"))
        .withColumn("line_margin_cents", F.col("line_revenue_cents") - F.col("line_cogs_cents"))
    )


def sales_detail(m: Model) -> DataFrame:
    """J1 ``sales_detail``: Delivered order lines, enriched, money in dollars."""
    s = sales_cents(m)
    return s.select(
        "order_line_id", "order_id", "product_id", "quantity",
        dollars(F.col("price_cents")).alias("unit_price_at_sale"),
        dollars(F.col("line_revenue_cents")).alias("line_revenue"),
        dollars(F.col("line_margin_cents")).alias("line_margin"),
        dollars(F.col("line_cogs_cents")).alias("line_cogs"),
        "order_date", "warehouse_id", "customer_id", "status", "sku", "category",
        dollars(F.col("unit_cost_cents")).alias("unit_cost"),
        "supplier_id", "warehouse_name", "warehouse_region",
    )


def inventory_cents(m: Model) -> DataFrame:
    p = m.products.select("product_id", "sku", "category", "unit_cost_cents", "unit_price_cents",
                          "reorder_point", "safety_stock", "supplier_id")
    w = m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"),
                            F.col("region").alias("warehouse_region"))
    return (
        m.inventory.join(p, "product_id").join(w, "warehouse_id")
        .withColumn("inventory_value_cents",
                    F.col("quantity_on_hand").cast("long") * F.col("unit_cost_cents"))
    )


def inventory_detail(m: Model) -> DataFrame:
    """J2 ``inventory_detail``: positions with product and warehouse context."""
    i = inventory_cents(m)
    return i.select(
        "warehouse_id", "product_id", "quantity_on_hand", "last_restock_date",
        dollars(F.col("inventory_value_cents")).alias("inventory_value"),
        "sku", "category",
        dollars(F.col("unit_cost_cents")).alias("unit_cost"),
        dollars(F.col("unit_price_cents")).alias("unit_price"),
        "reorder_point", "safety_stock", "supplier_id", "warehouse_name", "warehouse_region",
    )
