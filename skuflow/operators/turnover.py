"""Annualised inventory turnover and days of supply per category.

turnover = (Delivered COGS * 365 / period_days) / inventory value at cost,
period_days = max(last - first Delivered sale date, 1).  Categories present on
only one side are kept (full outer join, zero fill).  Turnover is rounded
(half-to-even, like the reference's pandas) before days of supply is derived
from it; a zero turnover gives NULL days instead of infinity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import dollars, money_sum, round_half_even, sort_bounded
from skuflow.operators.abc import product_sales
from skuflow.operators.detail import line_facts
from skuflow.sources.model import Model


def inventory_turnover(m: Model, days_per_year: int = 365) -> DataFrame:
    period_days = F.greatest(F.datediff(m.scalar("max_delivered_date"), m.scalar("min_delivered_date")), F.lit(1))
    cogs = product_sales(m).groupBy("category").agg(F.sum("cogs_cents").alias("cogs_cents"))
    p = m.products.select("product_id", "category", "unit_cost_cents")
    value = (m.inventory.join(p, "product_id").groupBy("category")
             .agg(money_sum(F.col("quantity_on_hand") * F.col("unit_cost_cents")).alias("value_cents")))
    merged = cogs.join(value, "category", "full_outer").select(
        "category",
        dollars(F.coalesce("cogs_cents", F.lit(0))).alias("line_cogs"),
        dollars(F.coalesce("value_cents", F.lit(0))).alias("inventory_value"),
    )
    annual = F.col("line_cogs") * (F.lit(float(days_per_year)) / period_days.cast("double"))
    turnover = round_half_even(annual / F.nullif(F.col("inventory_value"), F.lit(0.0)), 2)
    return (
        merged.withColumn("annualized_cogs", annual)
        .withColumn("inventory_turnover", turnover)
        .withColumn("days_of_supply", round_half_even(
            F.lit(float(days_per_year)) / F.nullif(F.col("inventory_turnover"), F.lit(0.0)), 1))
        .select("category", "line_cogs", "annualized_cogs", "inventory_value", "inventory_turnover",
                "days_of_supply")
    ).transform(lambda d: sort_bounded(d, F.desc_nulls_last("inventory_turnover"), "category"))
