"""Sales-aware dead / slow-moving / overstocked classification per position.

Demand is Delivered units in the trailing window ending at the latest Delivered
sale (inclusive lower bound, divisor = window).  Thresholds act on the rounded
values (half-to-even, as the reference's pandas), and undefined ratios stay
NULL so they fall through the first-match classification.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import dollars, money_sum, pct, round_half_even, sort_bounded
from skuflow.operators.detail import inventory_cents, line_facts
from skuflow.sources.model import Model

# Fixed values of the classification.
STATUS_ORDER = ("Dead", "Slow-Moving", "Overstocked", "Healthy")
PROBLEM_STATUSES = ("Dead", "Slow-Moving")


def dead_stock_cents(m: Model, velocity_window_days: int = 90, slow_days: int = 180,
                     dead_ratio: float = 2, overstock_ratio: float = 4) -> DataFrame:
    facts = line_facts(m)
    snapshot = m.scalar("max_delivered_date")
    velocity = (
        facts.filter(F.col("order_date") >= F.date_sub(snapshot, velocity_window_days))
        .groupBy("warehouse_id", "product_id")
        .agg(F.sum("quantity").alias("units_recent"))
    )
    units = F.coalesce(F.col("units_recent"), F.lit(0)).cast("long")
    daily = units.cast("double") / F.lit(float(velocity_window_days))
    df = (
        inventory_cents(m).join(velocity, ["warehouse_id", "product_id"], "left")
        .withColumn("units_sold_recent", units)
        .withColumn("daily_demand", daily)
        .withColumn("days_of_supply", F.when(
            F.col("daily_demand") > 0,
            round_half_even(F.col("quantity_on_hand").cast("double") / F.col("daily_demand"), 1)))
        .withColumn("stock_ratio", round_half_even(
            F.col("quantity_on_hand").cast("double")
            / F.nullif(F.col("safety_stock").cast("double"), F.lit(0.0)), 2))
        .withColumn("days_since_restock", F.datediff(snapshot, F.col("last_restock_date")))
    )
    status = (
        F.when((F.col("units_sold_recent") == 0) & (F.col("stock_ratio") >= dead_ratio), "Dead")
        .when(F.col("days_of_supply") > slow_days, "Slow-Moving")
        .when(F.col("stock_ratio") >= overstock_ratio, "Overstocked")
        .otherwise("Healthy")
    )
    return df.withColumn("stock_status", status)


def dead_stock_detail(m: Model, velocity_window_days: int = 90, slow_days: int = 180, dead_ratio: float = 2,
                      overstock_ratio: float = 4) -> DataFrame:
    d = dead_stock_cents(m, velocity_window_days, slow_days, dead_ratio, overstock_ratio)
    return d.select(
        "warehouse_id", "warehouse_name", "product_id", "sku", "category", "quantity_on_hand",
        "safety_stock", "stock_ratio", dollars(F.col("unit_cost_cents")).alias("unit_cost"),
        dollars(F.col("inventory_value_cents")).alias("inventory_value"), "units_sold_recent",
        "daily_demand", "days_of_supply", "days_since_restock", "stock_status",
    ).orderBy(F.desc("inventory_value"), "warehouse_id", "product_id")


def dead_stock_summary(m: Model, velocity_window_days: int = 90, slow_days: int = 180, dead_ratio: float = 2,
                       overstock_ratio: float = 4) -> DataFrame:
    d = dead_stock_cents(m, velocity_window_days, slow_days, dead_ratio, overstock_ratio)
    g = d.groupBy("stock_status").agg(
        F.count(F.lit(1)).alias("positions"),
        F.sum("quantity_on_hand").alias("total_units"),
        money_sum(F.col("inventory_value_cents")).alias("value_cents"),
    )
    # At most four rows (one per status): the unpartitioned window is bounded.
    total = F.sum("value_cents").over(Window.partitionBy(F.lit(0)))
    return g.select(
        "stock_status", "positions", "total_units",
        dollars(F.col("value_cents")).alias("total_value"),
        pct(F.col("value_cents"), total).alias("pct_of_inventory_value"),
    ).transform(lambda d: sort_bounded(d, F.desc("total_value"), "stock_status"))


def dead_stock_by_category(m: Model, velocity_window_days: int = 90, slow_days: int = 180, dead_ratio: float = 2,
                           overstock_ratio: float = 4) -> DataFrame:
    d = dead_stock_cents(m, velocity_window_days, slow_days, dead_ratio, overstock_ratio)
    return (
        d.filter(F.col("stock_status").isin(*PROBLEM_STATUSES))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("problem_positions"),
             money_sum(F.col("inventory_value_cents")).alias("value_cents"))
        .select("category", "problem_positions", dollars(F.col("value_cents")).alias("capital_tied_up"))
    ).transform(lambda d: sort_bounded(d, F.desc("capital_tied_up"), "category"))
