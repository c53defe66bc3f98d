"""W7-W11 / M12-M17 at any date grain, from one table of shifted periods.

A date context is a stretch of calendar days: a day, month, quarter, year or fiscal year. The
calendar gives each of them the stretches that its measures read (``shifted_periods``):

* year to date: from the start of the (fiscal) year that holds the last day, to the last day;
* prior year and prior month: first and last day moved back by 12 months or 1, a day that the
  other month lacks becoming its last one; a stretch that ends with whole months keeps doing so
  (February 1-28 follows January 1-31, a single 28 February follows 28 January);
* trailing three months: of a month's end the three calendar months up to it, else the days
  after the same day three months earlier.

Facts are aggregated once, to (context, day). Every stretch is then the difference of two prefix
sums over days, read at its first and last day: the days and the wanted ends of one context go
through one ordered window, so the work grows with days and periods and not with the length of
the stretches. Sums are exact decimals. A stretch without sales is NULL; days outside the
calendar have no sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, FISCAL_START_MONTH, dollars, money_sum
from skuflow.plans.measures import DATE_KEYS, DIM_OF_KEY, family_frame
from skuflow.plans.star import dim_date
from skuflow.plans.timeintel import change_pct, yoy_arrow
from skuflow.sources.model import Model

#: Grain -> the columns of ``dim_date`` that name a period.
GRAINS = {"day": ("date_key",), "month": ("year_month",), "quarter": ("year", "quarter"), "year": ("year",), "fiscal_year": ("fiscal_year",)}
SPANS = ("cur", "ytd", "py", "pm", "r3")


def periods(m: Model, grain: str, fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """The calendar's periods of one grain: their names, first and last day."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    return dim_date(m, fiscal_start_month).groupBy(*GRAINS[grain]).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def _moved(months: int) -> tuple[Column, Column]:
    """The period, ``months`` earlier."""
    first, last = F.col("first_day"), F.col("last_day")
    whole = (last == F.last_day(last)) & (first <= F.trunc(last, "MM"))
    end = F.add_months(last, -months)
    return F.add_months(first, -months), F.when(whole, F.last_day(end)).otherwise(end)


def shifted_periods(calendar: DataFrame, year_start_month: int = 1) -> DataFrame:
    """One row per period and span it reads: the period's columns, span, lo, hi (days, both included)."""
    last = F.col("last_day")
    in_year = F.add_months(last, 1 - year_start_month)                    # lies in the calendar year in which last's year starts
    year_start = F.make_date(F.year(in_year), F.lit(year_start_month), F.lit(1))
    trailing = F.when(last == F.last_day(last), F.add_months(F.trunc(last, "MM"), -2)).otherwise(F.date_add(F.add_months(last, -3), 1))
    spans = {"cur": (F.col("first_day"), last), "ytd": (year_start, last), "py": _moved(12), "pm": _moved(1), "r3": (trailing, last)}
    rows = [F.struct(F.lit(name).alias("span"), lo.alias("lo"), hi.alias("hi")) for name, (lo, hi) in spans.items()]
    return calendar.select("*", F.explode(F.array(*rows)).alias("s")).select(*calendar.columns, "s.*")


def span_sums(daily: DataFrame, spans: DataFrame, by: list[str], period: list[str]) -> DataFrame:
    """Exact revenue and, for the trailing months, days with sales of every context, period and span.

    ``daily`` has one row per context and day with sales (order_date, day_c), ``spans`` one per
    context, period and span (lo, hi); both ends of a span are placed among the days of its context.
    """
    ends = spans.select(*by, *period, "span", F.explode(F.array(
        F.struct(F.date_sub("lo", 1).alias("day"), F.lit(-1).alias("sign")), F.struct(F.col("hi").alias("day"), F.lit(1).alias("sign")))).alias("e"))
    ends = ends.select(*by, *period, "span", "e.*", F.lit(None).cast(EXACT).alias("day_c"), F.lit(0).alias("days"))
    nothing = [F.lit(None).cast(ends.schema[c].dataType).alias(c) for c in (*period, "span")]
    days = daily.select(*by, *nothing, F.col("order_date").alias("day"), F.lit(0).alias("sign"), "day_c", F.lit(1).alias("days"))
    # The last day of a span counts: days (sign 0) come before ends of the same date.
    upto = Window.partitionBy(*by).orderBy("day", F.abs("sign")).rowsBetween(Window.unboundedPreceding, 0)
    both = days.unionByName(ends).withColumns({"sum_c": F.coalesce(F.sum("day_c").over(upto), F.lit(0).cast(EXACT)), "n": F.sum("days").over(upto)})
    sums = both.where("sign != 0").groupBy(*by, *period).pivot("span", list(SPANS)).agg(
        F.sum(F.col("sum_c") * F.col("sign")).cast(EXACT).alias("c"), F.sum(F.col("n") * F.col("sign")).alias("n"))
    return sums.select(*by, *period, *[F.when(F.col(f"{s}_n") > 0, F.col(f"{s}_c")).alias(f"{s}_c") for s in SPANS], F.col("r3_n"))


def period_measures(m: Model, grain: str = "month", by: list[str] | tuple[str, ...] = (), year_start_month: int = 1,
                    fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """M1 and M12-M17, M36 of Delivered revenue for every period of ``grain`` and every context of ``by``.

    ``year_start_month`` is where year to date begins, ``fiscal_start_month`` where periods of the
    grain fiscal_year do. Contexts are those
    with sales; every period of the calendar is returned for each, first_day naming it too.
    """
    by = list(by)
    bad = [k for k in by if k in DATE_KEYS or DIM_OF_KEY.get(k) not in ("product", "warehouse")]
    if bad:
        raise ValueError(f"revenue by period cannot be split by {bad}")
    sold = family_frame(m, "sales", set(by))
    daily = sold.where("order_date IS NOT NULL").groupBy(*by, "order_date").agg(money_sum(F.col("rev_c")).alias("day_c"))
    calendar = periods(m, grain, fiscal_start_month)
    period = calendar.columns
    if by:                                                                # the calendar, a bounded array, goes to each context
        whole = calendar.agg(F.collect_list(F.struct(*period))).scalar()
        calendar = daily.select(*by).distinct().select(*by, F.explode(whole).alias("p")).select(*by, "p.*")
    sums = span_sums(daily, shifted_periods(calendar, year_start_month), by, period)
    out = sums.select(
        *by, *GRAINS[grain], "first_day", dollars(F.col("cur_c")).alias("revenue"), dollars(F.col("ytd_c")).alias("revenue_ytd"),
        dollars(F.col("py_c")).alias("revenue_py"), change_pct("cur_c", "py_c").alias("revenue_yoy_pct"),
        dollars(F.col("pm_c")).alias("revenue_pm"), change_pct("cur_c", "pm_c").alias("revenue_mom_pct"),
        (dollars(F.col("r3_c")) / F.nullif(F.col("r3_n").cast("double"), F.lit(0.0))).alias("revenue_3m_avg"))
    return out.withColumn("revenue_yoy_arrow", yoy_arrow("revenue_yoy_pct"))


def fiscal_year_to_date(m: Model, by: list[str] | tuple[str, ...] = (), fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Revenue of each month and of the fiscal year up to its end."""
    out = period_measures(m, "month", by, fiscal_start_month)
    return out.select(*by, "year_month", "first_day", "revenue", F.col("revenue_ytd").alias("revenue_fytd"))
