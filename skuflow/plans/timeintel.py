"""Month-grain time intelligence over Delivered revenue.

Recipe: aggregate the facts to (context, day) and then (context, month),
keeping revenue and the number of days with sales; build a dense month spine
per context by exploding ``sequence(first, last, 1 month)`` over the distinct
context keys (a generator, linear in the output); left-join the months; then
ordered frames partitioned by the context: year-to-date is a running sum
within (context, year), prior month / prior year are ``lag`` 1 / 12 on the
dense spine, and the 3-month average is revenue over the last three months
divided by the days with sales in them.  Windows are partitioned by the
context; without context keys the partition is the month calendar itself
(bounded by the number of months, not by the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, money_sum, round_half_even, sort_bounded
from skuflow.plans.measures import BOUNDED_KEYS, DIM_OF_KEY, family_frame
from skuflow.sources.model import Model


def monthly_revenue_spine(m: Model, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    by = [k for k in by if k not in ("year_month", "year", "month")]
    bad = [k for k in by if DIM_OF_KEY.get(k) not in ("product", "warehouse", "date")]
    if bad:
        raise ValueError(f"sales cannot be filtered by {bad}")
    f = family_frame(m, "sales", set(by) | {"date_key"})
    daily = f.groupBy(*by, "order_date").agg(money_sum(F.col("rev_c")).alias("day_c"))
    monthly = (daily.withColumn("month_start", F.trunc("order_date", "MM"))
               .groupBy(*by, "month_start")
               .agg(F.sum("day_c").alias("rev_c"), F.count(F.lit(1)).alias("sales_days")))
    # Calendar-year span of the Delivered sales so that year-to-date starts in January.
    lo = F.make_date(F.year(m.scalar("min_delivered_date")), F.lit(1), F.lit(1))
    hi = F.make_date(F.year(m.scalar("max_delivered_date")), F.lit(12), F.lit(1))
    contexts = monthly.select(*by).distinct() if by else m.spark.range(1).select()
    spine = contexts.select(*by, F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return spine.join(monthly, [*by, "month_start"], "left")


def change_pct(current: str, previous: str) -> Column:
    """Relative change between two exact amounts; no sales now count as zero, none before give NULL."""
    zero = F.lit(0).cast(EXACT)
    return (F.coalesce(F.col(current), zero) - F.col(previous)).cast("double") / F.nullif(F.col(previous).cast("double"), F.lit(0.0))


def yoy_arrow(change: str) -> Column:
    """Direction and size of a change, empty where it is unknown."""
    pct = F.format_string("%.1f%%", round_half_even(F.col(change) * 100, 1))
    return (F.when(F.col(change).isNull(), F.lit(""))
            .when(F.col(change) > 0, F.concat(F.lit("▲ "), pct))
            .when(F.col(change) < 0, F.concat(F.lit("▼ "), pct))
            .otherwise(F.lit("– 0.0%")))


def revenue_time_intelligence(m: Model, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Per context and month: revenue, YTD, PY, YoY %, PM, MoM %, 3M average, YoY arrow."""
    by = [k for k in by if k not in ("year_month", "year", "month")]
    s = monthly_revenue_spine(m, by)
    ctx = Window.partitionBy(*by).orderBy("month_start") if by else Window.orderBy("month_start")
    ytd_w = (Window.partitionBy(*by, F.year("month_start")).orderBy("month_start")
             .rowsBetween(Window.unboundedPreceding, 0))
    last3 = ctx.rowsBetween(-2, 0)
    cur = F.col("rev_c")
    dollars = lambda c: c.cast("double") / F.lit(100)
    py, pm = F.lag(cur, 12).over(ctx), F.lag(cur, 1).over(ctx)
    out = s.select(
        *by, "month_start", F.date_format("month_start", "yyyy-MM").alias("year_month"), cur,
        F.sum(cur).over(ytd_w).alias("ytd_c"), py.alias("py_c"), pm.alias("pm_c"),
        F.sum(cur).over(last3).alias("r3_c"), F.sum("sales_days").over(last3).alias("d3"),
    )
    return (
        out.select(
            *by, "year_month",
            dollars(cur).alias("revenue"),
            dollars(F.col("ytd_c")).alias("revenue_ytd"),
            dollars(F.col("py_c")).alias("revenue_py"),
            change_pct("rev_c", "py_c").alias("revenue_yoy_pct"),
            dollars(F.col("pm_c")).alias("revenue_pm"),
            change_pct("rev_c", "pm_c").alias("revenue_mom_pct"),
            (F.col("r3_c").cast("double") / F.lit(100) / F.nullif(F.col("d3").cast("double"), F.lit(0.0)))
            .alias("revenue_3m_avg"),
        )
        .withColumn("revenue_yoy_arrow", yoy_arrow("revenue_yoy_pct"))
        .transform(lambda d: sort_bounded(d, *by, "year_month") if set(by) <= BOUNDED_KEYS
                   else d.orderBy(*by, "year_month"))
    )
