"""Composite supplier scorecard and the after-the-fact audit against the hidden seed.

Per supplier, from Delivered purchase orders only: share on time, mean and
spread of the clipped lateness (early never offsets late).  Spread is the
sample standard deviation computed from exact integer moments
(n, sum x, sum x^2), so it is identical however the rows are partitioned.
Severity and consistency are scaled against the worst supplier that passed
the minimum-sample filter. The per-supplier moments are computed once per model
(a checkpoint of one row per supplier), so the maximum and every later use read
those rows and not the purchase orders again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, pearson, round_half_even
from skuflow.session import ensure_checkpoint_dir
from skuflow.sources.model import Model

# Fixed values of the scorecard (weights, tier cut-offs, audit bands).
WEIGHTS = (0.50, 0.30, 0.20)
TIERS = ((85, "Preferred"), (65, "Monitor"))
TIER_FLOOR = "High Risk"
AUDIT_BANDS = ((0.7, "Strong - the scorecard recovers the underlying reliability well"),
               (0.4, "Moderate - scorecard partially recovers underlying reliability"))
AUDIT_FLOOR = "Weak - methodology may need review"


def supplier_stats(m: Model, min_delivered_pos: int = 5) -> DataFrame:
    """Lateness of the suppliers with enough delivered purchase orders, computed once per model."""
    key = f"supplier_stats:{min_delivered_pos}"
    if key not in m.memo:
        ensure_checkpoint_dir(m.spark)
        m.memo[key] = _supplier_stats(m, min_delivered_pos).checkpoint(eager=True)
    return m.memo[key]


def _supplier_stats(m: Model, min_delivered_pos: int) -> DataFrame:
    po = m.purchase_orders.filter(F.col("actual_delivery_date").isNotNull())
    delay = F.datediff("actual_delivery_date", "expected_delivery_date")
    late_only = F.greatest(delay, F.lit(0)).cast("long")
    agg = po.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("delivered_pos"),
        F.count_if(delay > 0).alias("late_pos"),
        F.sum(late_only).alias("late_sum"),
        F.sum((late_only * late_only).cast(EXACT)).alias("late_sumsq"),
        F.max(late_only).alias("max_delay_days"),
    ).filter(F.col("delivered_pos") >= min_delivered_pos)
    n = F.col("delivered_pos")
    var_num = F.col("delivered_pos").cast(EXACT) * F.col("late_sumsq") \
        - F.col("late_sum").cast(EXACT) * F.col("late_sum").cast(EXACT)
    var_den = F.nullif((n * (n - 1)).cast(EXACT), F.lit(0).cast(EXACT))
    return agg.select(
        "supplier_id", "delivered_pos", "late_pos", "max_delay_days",
        (F.col("late_sum").cast("double") / n.cast("double")).alias("avg_late"),
        F.coalesce(F.sqrt(var_num.cast("double") / var_den.cast("double")), F.lit(0.0)).alias("delay_std"),
    )


def supplier_scorecard(m: Model, min_delivered_pos: int = 5, weights: tuple[float, float, float] = WEIGHTS,
                       tiers: tuple[tuple[float, str], ...] = TIERS, floor: str = TIER_FLOOR) -> DataFrame:
    """Weights are for on time, delay and consistency; a tier begins at its score, the rest is the floor."""
    st = supplier_stats(m, min_delivered_pos)
    worst = st.agg(F.max("avg_late").alias("a"), F.max("delay_std").alias("s"))
    # one scalar subquery, attached once as a column and then referenced
    st = st.withColumn("_worst", worst.select(F.struct("a", "s")).scalar())
    worst_avg, worst_std = F.col("_worst.a"), F.col("_worst.s")
    one = F.lit(1.0)
    on_time = round_half_even((one - F.col("late_pos").cast("double") / F.col("delivered_pos").cast("double"))
                              * F.lit(100.0), 2)
    delay_score = F.when(worst_avg > 0, F.lit(100.0) * (one - F.col("avg_late") / worst_avg)).otherwise(100.0)
    consistency = F.when(worst_std > 0, F.lit(100.0) * (one - F.col("delay_std") / worst_std)).otherwise(100.0)
    w_on, w_delay, w_cons = weights
    composite = round_half_even(F.lit(w_on) * F.col("on_time_score") + F.lit(w_delay) * F.col("delay_raw")
                                + F.lit(w_cons) * F.col("consistency_raw"), 2)
    tier = F.lit(floor)
    for cut, label in sorted(tiers):
        tier = F.when(F.col("composite_score") >= cut, F.lit(label)).otherwise(tier)
    s = m.suppliers.select("supplier_id", F.col("name").alias("supplier_name"), "region",
                           "primary_category", "base_reliability_score")
    return (
        st.withColumn("on_time_score", on_time)
        .withColumn("delay_raw", delay_score)
        .withColumn("consistency_raw", consistency)
        .withColumn("composite_score", composite)
        .withColumn("risk_tier", tier)
        .join(s, "supplier_id", "left")
        .select(
            "supplier_id", "supplier_name", "region", "primary_category", "delivered_pos", "late_pos",
            round_half_even((F.lit(100) * F.col("late_pos")).cast("double")
                            / F.col("delivered_pos").cast("double"), 2).alias("late_delivery_rate_pct"),
            round_half_even(F.col("avg_late"), 2).alias("avg_delay_days"),
            "max_delay_days", "on_time_score",
            round_half_even(F.col("delay_raw"), 2).alias("delay_score"),
            round_half_even(F.col("consistency_raw"), 2).alias("consistency_score"),
            "composite_score", "risk_tier", "base_reliability_score",
        )
        .orderBy("composite_score", "supplier_id")
    )


def scorecard_audit(m: Model, min_delivered_pos: int = 5, bands: tuple[tuple[float, str], ...] = AUDIT_BANDS, floor: str = AUDIT_FLOOR,
                    weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """Correlation of the composite score with the hidden generation seed (audit only).

    Scores have two decimals and seeds are taken to nine, so both are whole numbers to the correlation.
    """
    sc = supplier_scorecard(m, min_delivered_pos, weights)
    r = round_half_even(pearson(F.rint(F.col("composite_score") * 100), F.rint(F.col("base_reliability_score") * 1e9)), 3)
    label = F.lit(floor)
    for cut, text in sorted(bands):
        label = F.when(F.col("correlation") > cut, F.lit(text)).otherwise(label)
    return sc.agg(r.alias("correlation"), F.count(F.lit(1)).alias("suppliers_scored")) \
             .withColumn("interpretation", label)


def risk_tier_counts(m: Model, min_delivered_pos: int = 5) -> DataFrame:
    """Number of scored suppliers per risk tier (value counts)."""
    from skuflow.functions.exprs import sort_bounded
    counts = supplier_scorecard(m, min_delivered_pos).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("suppliers"))
    return sort_bounded(counts, F.desc("suppliers"), "risk_tier")   # at most three tiers
