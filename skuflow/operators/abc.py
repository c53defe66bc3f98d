"""ABC classification by cumulative revenue share, and its per-class summary.

Revenue is aggregated per product on the fact side first (lines of Delivered
orders), then looked up against the product dimension; the global running
share comes from ``prefix.running_totals`` so no task ever holds more than a
bounded slice of the products.  Class boundaries are compared exactly in
integer cents: ``cum * 10^6 <= total * round(threshold * 10^6)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, dollars, exact, money_sum, pct, sort_bounded
from skuflow.operators.prefix import running_totals
from skuflow.sources.model import Model

_SCALE = 10 ** 6


def product_sales(m: Model, statuses: tuple[str, ...] | None = ("Delivered",)) -> DataFrame:
    """Per-product revenue, units and margin in cents, aggregated before any dimension join."""
    f = m.facts
    if statuses is not None:
        f = f.filter(F.col("status").isin(*statuses))
    per_product = (
        f.groupBy("product_id")
        .agg(money_sum(F.col("quantity") * F.col("price_cents")).alias("revenue_cents"),
             F.sum("quantity").alias("units_sold"))
    )
    p = m.products.select("product_id", "sku", "category", "unit_cost_cents")
    return (
        per_product.join(p, "product_id")
        .withColumn("cogs_cents", exact(F.col("unit_cost_cents")) * F.col("units_sold"))
        .withColumn("margin_cents", F.col("revenue_cents") - F.col("cogs_cents"))
    )


def _threshold(t: float) -> F.Column:
    return F.lit(int(round(t * _SCALE))).cast(EXACT)


def _ranked(m: Model) -> DataFrame:
    """Products by revenue with running and total revenue, ranked once per model."""
    if "ranked" not in m.memo:
        m.memo["ranked"] = running_totals(
            product_sales(m), [("revenue_cents", True), ("product_id", False)], "revenue_cents",
            cum_col="cum_cents", total_col="total_cents", count_col="n_classified")
    return m.memo["ranked"]


def classify_cents(m: Model, a_threshold: float = 0.80, b_threshold: float = 0.95) -> DataFrame:
    """ABC rows with exact cent columns (internal form used by the star schema too)."""
    ranked = _ranked(m)
    scaled_cum = F.col("cum_cents") * F.lit(_SCALE).cast(EXACT)
    return ranked.withColumn(
        "abc_class",
        F.when(scaled_cum <= F.col("total_cents") * _threshold(a_threshold), "A")
        .when(scaled_cum <= F.col("total_cents") * _threshold(b_threshold), "B")
        .otherwise("C"),
    )


def classify_abc(m: Model, a_threshold: float = 0.80, b_threshold: float = 0.95) -> DataFrame:
    """C7 ``abc_classification``: one row per product with Delivered sales."""
    c = classify_cents(m, a_threshold, b_threshold)
    return c.select(
        "product_id", "sku", "category",
        dollars(F.col("revenue_cents")).alias("total_revenue"),
        dollars(F.col("margin_cents")).alias("total_margin"),
        "units_sold",
        (F.col("revenue_cents").cast("double") / F.col("total_cents").cast("double")).alias("revenue_share"),
        (F.col("cum_cents").cast("double") / F.col("total_cents").cast("double"))
        .alias("cumulative_revenue_share"),
        "abc_class", "rank",
    )


def abc_summary(m: Model, a_threshold: float = 0.80, b_threshold: float = 0.95) -> DataFrame:
    """C7 ``abc_summary``: SKU count and revenue share per class."""
    c = classify_cents(m, a_threshold, b_threshold)
    g = c.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("sku_count"),
        F.sum("revenue_cents").alias("revenue_cents"),
        F.sum("margin_cents").alias("margin_cents"),
        F.sum("units_sold").alias("units_sold"),
    )
    # g has at most three rows (one per class): an unpartitioned window is bounded.
    every = Window.partitionBy(F.lit(0))
    n_total, rev_total = F.sum("sku_count").over(every), F.sum("revenue_cents").over(every)
    return g.select(
        "abc_class", "sku_count",
        dollars(F.col("revenue_cents")).alias("total_revenue"),
        dollars(F.col("margin_cents")).alias("total_margin"),
        "units_sold",
        pct(F.col("sku_count"), n_total).alias("pct_of_skus"),
        pct(F.col("revenue_cents"), rev_total).alias("pct_of_revenue"),
    ).transform(lambda d: sort_bounded(d, "abc_class"))
