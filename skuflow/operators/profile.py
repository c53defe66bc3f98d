"""Formulas of the reference's data generator re-aimed at observed data.

R1 sizes safety stock and reorder point from observed demand, R2 ranks
products by demand (average-of-ties percentile), R3 measures seasonality per
calendar month, R4 profiles the order mix.  Nothing here is simulated: every
operator reads the model and grows with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import sort_bounded

from skuflow.operators.prefix import tied_ranks
from skuflow.operators.selection import exact_quantiles
from skuflow.sources.model import Model

# Fixed values of the threshold formula.
SAFETY_STOCK_FACTOR = 0.5
MIN_SAFETY_STOCK = 2


def _units_per_product(m: Model) -> DataFrame:
    """Units sold per product over all statuses; products without sales get 0."""
    sold = m.order_lines.groupBy("product_id").agg(F.sum("quantity").cast("long").alias("units"))
    return (m.products.select("product_id", "sku", "category", "supplier_id", "safety_stock", "reorder_point")
            .join(sold, "product_id", "left")
            .withColumn("units_sold", F.coalesce("units", F.lit(0).cast("long"))).drop("units"))


def stock_thresholds(m: Model, safety_factor: float = SAFETY_STOCK_FACTOR,
                     min_safety: int = MIN_SAFETY_STOCK) -> DataFrame:
    """Per-warehouse thresholds from observed demand and supplier lead time.

    lead_time_demand = units / period_days / warehouses * lead_time;
    safety = max(ceil(ltd * factor), min); reorder = max(ceil(ltd + safety), safety + 1).
    """
    period_days = F.greatest(F.datediff(m.scalar("max_order_date"), m.scalar("min_order_date")), F.lit(1))
    n_wh = m.scalar("warehouse_count")
    lead = m.suppliers.select("supplier_id", F.col("avg_lead_time_days").alias("lead_time_days"))
    base = _units_per_product(m).join(lead, "supplier_id", "left")
    daily = F.col("units_sold").cast("double") / period_days / n_wh
    ltd = daily * F.col("lead_time_days")
    safety = F.greatest(F.ceil(F.col("lead_time_demand") * safety_factor), F.lit(min_safety)).cast("int")
    return (
        base.select("product_id", "sku", "category", "supplier_id", "units_sold",
                    daily.alias("daily_demand_per_warehouse"), "lead_time_days",
                    ltd.alias("lead_time_demand"), "safety_stock", "reorder_point")
        .withColumn("recommended_safety_stock", safety)
        .withColumn("recommended_reorder_point",
                    F.greatest(F.ceil(F.col("lead_time_demand") + F.col("recommended_safety_stock")),
                               F.col("recommended_safety_stock") + 1).cast("int"))
    )


def demand_percentile(m: Model, ranges: int | None = None) -> DataFrame:
    """Rank percentile of units sold, ties get the average rank.

    pct = (rows with fewer units + (ties + 1) / 2) / n, from ``prefix.tied_ranks``: a common
    number of units (0 above all) is counted in many ranges and joined with nothing.
    """
    ranked = tied_ranks(_units_per_product(m).select("product_id", "sku", "category", "units_sold"), "units_sold", ["product_id"], ranges=ranges)
    pct = (F.lit(2) * F.col("fewer") + F.col("ties") + 1).cast("double") / (F.lit(2) * F.col("n")).cast("double")
    return ranked.select("product_id", "sku", "category", "units_sold", pct.alias("demand_percentile"))


def line_revenue_quantiles(m: Model, shares=(0.25, 0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    """Exact quantiles of the revenue of single order lines (all statuses), in cents and interpolated dollars."""
    lines = m.order_lines.select((F.col("quantity") * F.col("price_cents")).alias("revenue_cents"))
    q = exact_quantiles(lines, "revenue_cents", shares)
    return q.select("share", F.col("lower").alias("lower_cents"), F.col("upper").alias("upper_cents"), (F.col("value") / 100).alias("revenue"))


def seasonal_index(m: Model) -> DataFrame:
    """Orders per calendar month relative to the mean month (all statuses)."""
    per_month = m.orders.groupBy(F.month("order_date").alias("month")).agg(
        F.count(F.lit(1)).alias("order_count"))
    every = Window.partitionBy(F.lit(0))  # at most 12 rows
    return per_month.select(
        "month", "order_count",
        (F.col("order_count") * F.count(F.lit(1)).over(every)).cast("double")
        / F.sum("order_count").over(every).cast("double"),
    ).toDF("month", "order_count", "seasonal_index").transform(lambda d: sort_bounded(d, "month"))


def order_mix_profile(m: Model) -> DataFrame:
    """Status shares, lines per order, units per line, share of lines below list price."""
    status = m.orders.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # one row per status value
    shares = status.select(F.concat(F.lit("status_share:"), F.col("status")).alias("metric"),
                           (F.col("n").cast("double") / F.sum("n").over(every).cast("double")).alias("value"))
    # lines at one price of a product are counted before the lookup, so a hot product is a few rows in the join
    prices = m.order_lines.groupBy("product_id", "price_cents").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"))
    known = m.products.select("product_id", "unit_price_cents")
    agg = prices.join(known, "product_id").agg(
        F.sum("n").alias("lines"), F.sum("q").alias("units"),
        F.sum(F.when(F.col("price_cents") < F.col("unit_price_cents"), F.col("n")).otherwise(0)).alias("below"))
    agg = agg.withColumn("orders", m.order_lines.agg(F.countDistinct("order_id")).scalar())
    other = agg.select(F.expr(
        "stack(3, 'lines_per_order', CAST(lines AS DOUBLE) / CAST(orders AS DOUBLE), "
        "'units_per_line', CAST(units AS DOUBLE) / CAST(lines AS DOUBLE), "
        "'share_lines_below_list_price', CAST(below AS DOUBLE) / CAST(lines AS DOUBLE)) AS (metric, value)"))
    return reduce(DataFrame.unionByName, [shares, other])
