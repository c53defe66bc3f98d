"""The BI measure library as aggregate expressions over a filter context.

``evaluate(model, measures, by)`` plays the role of a visual: ``by`` is the
filter context (any dimension attributes; empty = grand total).  Each measure
belongs to one fact *family*; families are aggregated separately on the
context keys (each a partial + final hash aggregate) and then merged with a
union + group-by on the keys, never by joining fact to fact (the BI model's
single-direction relationships).  Ratios are derived after the merge so they
can combine families (e.g. turnover = COGS / inventory value).

Money is summed in exact integer cents and converted to dollars at the end;
ratios are fractions (0.27, not 27 %), NULL when the denominator is zero or
blank, like DAX ``DIVIDE``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT, date_key, fiscal_year, money_sum
from skuflow.operators.abc import classify_cents
from skuflow.operators.scorecard import supplier_scorecard
from skuflow.sources.model import Model

# --- context attributes and which dimension provides them -----------------------
PRODUCT_KEYS = ("product_id", "sku", "category", "abc_class")
WAREHOUSE_KEYS = ("warehouse_id", "warehouse_name", "warehouse_region")
DATE_KEYS = ("date_key", "year", "quarter", "month", "year_month", "fiscal_year")
SUPPLIER_KEYS = ("supplier_id", "supplier_name", "supplier_region", "risk_tier")

# D8 relationships: which dimensions each family can filter through.
FAMILY_DIMS = {
    "lines": ("product", "warehouse", "date"),
    "lines_product": ("product", "warehouse", "date"),
    "sales": ("product", "warehouse", "date"),
    "orders": ("product", "warehouse", "date"),
    "inventory": ("product", "warehouse"),
    "purchase_orders": ("supplier", "date", "product"),
    "supplier_dim": ("supplier",),
    "product_dim": ("product",),
    "date_dim": ("date",),
}
# Context keys whose cardinality is bounded by a small dimension or the calendar.
BOUNDED_KEYS = {"category", "abc_class", "warehouse_id", "warehouse_name", "warehouse_region", "year", "quarter",
                "month", "year_month", "fiscal_year", "supplier_region", "risk_tier"}
DIM_OF_KEY = {**{k: "product" for k in PRODUCT_KEYS}, **{k: "warehouse" for k in WAREHOUSE_KEYS},
              **{k: "date" for k in DATE_KEYS}, **{k: "supplier" for k in SUPPLIER_KEYS}}


def _c(name: str) -> Column:
    return F.col(name)


def _dollars_of(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100)


def _div(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class Measure:
    """A measure: an aggregate over one family, or a derivation over other measures."""

    name: str
    family: str | None
    agg: Callable[[], Column] | None = None
    derive: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()
    label: str = ""


def _m(name, family, agg, label):
    return Measure(name, family, agg=agg, label=label)


def _d(name, needs, derive, label):
    return Measure(name, None, derive=derive, needs=needs, label=label)


# Hidden intermediate aggregates (cents) used by derived measures.
def _delivered() -> Column:
    return F.col("status") == "Delivered"


def _dsum(c: str) -> Column:
    """Sum over Delivered orders only (NULL when there are none)."""
    return F.sum(F.when(_delivered(), F.col(c)))


# Hidden intermediate aggregates (cents) used by derived measures.  The
# "lines" family is pre-aggregated to (context, order, status) grain, so
# order counts are plain conditional counts (no distinct aggregation).
_HIDDEN = [
    _m("_rev_c", "lines", lambda: _dsum("rev_c"), ""),
    _m("_margin_c", "lines", lambda: _dsum("margin_c"), ""),
    _m("_cogs_c", "lines", lambda: _dsum("cogs_c"), ""),
    _m("_lines", "lines", lambda: _dsum("n_lines"), ""),
    _m("_inv_c", "inventory", lambda: money_sum(_c("value_c")), ""),
    _m("_dead_c", "inventory", lambda: F.sum(F.when(_c("quantity_on_hand") >= _c("safety_stock") * 4,
                                                    _c("value_c").cast(EXACT))), ""),
    _m("_positions", "inventory", lambda: F.count(F.lit(1)), ""),
    _m("_orders_all", "lines", lambda: F.count(F.lit(1)), ""),
    # Class A revenue: Delivered revenue aggregated to (context, product) first,
    # then classified - the product-level ABC table never meets line rows.
    _m("_a_rev_c", "lines_product",
       lambda: F.sum(F.when(_c("abc_class") == "A", _c("rev_c"))), ""),
]

MEASURES: dict[str, Measure] = {m.name: m for m in _HIDDEN + [
    _d("total_revenue", ("_rev_c",), lambda: _dollars_of(_c("_rev_c")), "M1 Total Revenue"),
    _d("total_margin", ("_margin_c",), lambda: _dollars_of(_c("_margin_c")), "M2 Total Margin"),
    _d("total_cogs", ("_cogs_c",), lambda: _dollars_of(_c("_cogs_c")), "M3 Total COGS"),
    _d("margin_pct", ("_margin_c", "_rev_c"), lambda: _div(_c("_margin_c"), _c("_rev_c")), "M4 Margin %"),
    _m("total_units_sold", "lines", lambda: _dsum("units").cast("long"), "M5 Total Units Sold"),
    _m("order_count", "lines", lambda: F.nullif(F.count_if(_delivered()), F.lit(0).cast("long")),
       "M6 Order Count"),
    _d("average_order_value", ("_rev_c", "order_count"),
       lambda: _dollars_of(_c("_rev_c")) / F.nullif(_c("order_count").cast("double"), F.lit(0.0)),
       "M7 Average Order Value"),
    _d("lines_per_order", ("_lines", "order_count"), lambda: _div(_c("_lines"), _c("order_count")),
       "M8 Lines per Order"),
    _m("returned_orders", "lines", lambda: F.count_if(_c("status") == "Returned"), "M9 Returned Orders"),
    _d("return_rate", ("returned_orders", "_orders_all"),
       lambda: _div(_c("returned_orders"), _c("_orders_all")), "M10 Return Rate %"),
    _m("delivered_revenue", "lines", lambda: _dollars_of(_dsum("rev_c")), "M11 Delivered Revenue"),
    _d("inventory_value", ("_inv_c",), lambda: _dollars_of(_c("_inv_c")), "M18 Inventory Value"),
    _m("units_on_hand", "inventory", lambda: F.sum("quantity_on_hand").cast("long"), "M19 Units On Hand"),
    _m("skus_below_reorder_point", "inventory",
       lambda: F.count_if(_c("quantity_on_hand") < _c("reorder_point")), "M20 SKUs Below Reorder Point"),
    _d("stockout_risk_pct", ("skus_below_reorder_point", "_positions"),
       lambda: _div(_c("skus_below_reorder_point"), _c("_positions")), "M21 Stockout Risk %"),
    _d("inventory_turnover", ("_cogs_c", "_inv_c"), lambda: _div(_c("_cogs_c"), _c("_inv_c")),
       "M22 Inventory Turnover (not annualised)"),
    _d("days_of_supply", ("_cogs_c", "_inv_c"),
       lambda: F.lit(365.0) / F.nullif(_div(_c("_cogs_c"), _c("_inv_c")), F.lit(0.0)), "M23 Days of Supply"),
    _d("dead_stock_value", ("_dead_c",), lambda: _dollars_of(_c("_dead_c")), "M24 Dead Stock Value"),
    _d("dead_stock_pct", ("_dead_c", "_inv_c"), lambda: _div(_c("_dead_c"), _c("_inv_c")),
       "M25 Dead Stock % of Inventory"),
    _m("purchase_order_count", "purchase_orders", lambda: F.count(F.lit(1)), "M26 Purchase Order Count"),
    _m("delivered_pos", "purchase_orders", lambda: F.count_if(_c("is_delivered")), "M27 Delivered POs"),
    _m("late_pos", "purchase_orders", lambda: F.count_if(_c("is_late")), "M28 Late POs"),
    _d("late_delivery_rate", ("late_pos", "delivered_pos"), lambda: _div(_c("late_pos"), _c("delivered_pos")),
       "M29 Late Delivery Rate %"),
    _d("on_time_delivery_rate", ("late_pos", "delivered_pos"),
       lambda: F.lit(1.0) - F.coalesce(_div(_c("late_pos"), _c("delivered_pos")), F.lit(0.0)),
       "M30 On-Time Delivery Rate %"),
    _m("average_delay_days", "purchase_orders",
       lambda: _div(F.sum(F.when(_c("is_delivered"), _c("delay_days"))),
                    F.count(F.when(_c("is_delivered"), _c("delay_days")))), "M31 Average Delay Days"),
    _m("high_risk_suppliers", "supplier_dim",
       lambda: F.countDistinct(F.when(_c("risk_tier") == "High Risk", _c("supplier_id"))),
       "M32 High Risk Suppliers"),
    _d("class_a_revenue", ("_a_rev_c",), lambda: _dollars_of(_c("_a_rev_c")), "M33 Class A Revenue"),
    _m("class_a_sku_count", "product_dim",
       lambda: F.countDistinct(F.when(_c("abc_class") == "A", _c("product_id"))), "M35 Class A SKU Count"),
    _m("selected_period_label", "date_dim",
       lambda: F.concat(F.date_format(F.min("date"), "MMM yyyy"), F.lit(" – "),
                        F.date_format(F.max("date"), "MMM yyyy")), "M37 Selected Period Label"),
]}

PUBLIC_MEASURES = tuple(n for n in MEASURES if not n.startswith("_"))


def _date_attrs(d: Column) -> list[Column]:
    """Calendar attributes of a fact row; the fiscal year is that of ``dim_date``'s default."""
    return [date_key(d).alias("date_key"), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
            F.month(d).alias("month"), F.date_format(d, "yyyy-MM").alias("year_month"),
            fiscal_year(d).alias("fiscal_year")]


def _product_dim(m: Model, keys: set[str]) -> DataFrame:
    p = m.products.select("product_id", "sku", "category")
    if "abc_class" in keys:
        abc = classify_cents(m).select("product_id", "abc_class")
        p = p.join(abc, "product_id", "left").withColumn("abc_class", F.coalesce("abc_class", F.lit("C")))
    return p


def _warehouse_dim(m: Model) -> DataFrame:
    return m.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"),
                               F.col("region").alias("warehouse_region"))


def _supplier_dim(m: Model, keys: set[str]) -> DataFrame:
    s = m.suppliers.select("supplier_id", F.col("name").alias("supplier_name"),
                           F.col("region").alias("supplier_region"))
    if "risk_tier" in keys:
        tiers = supplier_scorecard(m).select("supplier_id", "risk_tier")
        s = s.join(tiers, "supplier_id", "left") \
             .withColumn("risk_tier", F.coalesce("risk_tier", F.lit("Insufficient Data")))
    return s


def _need(keys: set[str], dim: str) -> bool:
    return any(DIM_OF_KEY.get(k) == dim for k in keys)


def _related(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows with the attributes of their dimension row.

    A row without one belongs to the dimension's blank member: all its attributes, the key
    included, are NULL, so that every context adds up to the total.
    """
    known = dim.withColumnRenamed(key, "_key")
    return fact.join(known, F.col(key) == F.col("_key"), "left").withColumn(key, F.col("_key")).drop("_key")


def family_frame(m: Model, family: str, keys: set[str]) -> DataFrame:
    """Fact rows of ``family`` with only the dimension attributes the context needs."""
    if family in ("sales", "sales_all"):
        f = m.facts if family == "sales_all" else m.facts.filter(F.col("status") == "Delivered")
        cols = [F.col("*"), (F.col("quantity") * F.col("price_cents")).alias("rev_c"),
                (F.col("quantity").cast("long") * F.col("unit_cost_cents")).alias("cogs_c")]
        if _need(keys, "date"):
            cols += _date_attrs(F.col("order_date"))
        f = f.select(*cols).withColumnRenamed("product_category", "category")
        if _need(keys - {"category"}, "product"):                         # the category is on the line
            f = _related(f.drop("category"), _product_dim(m, keys), "product_id")
        if _need(keys, "warehouse"):
            f = _related(f, _warehouse_dim(m), "warehouse_id")
        return f
    if family == "inventory":
        p = m.products.select("product_id", "unit_cost_cents", "reorder_point", "safety_stock")
        f = m.inventory.join(p, "product_id", "left").withColumn(
            "value_c", F.col("quantity_on_hand").cast("long") * F.col("unit_cost_cents"))
        if _need(keys, "product"):
            f = _related(f, _product_dim(m, keys), "product_id")
        if _need(keys, "warehouse"):
            f = _related(f, _warehouse_dim(m), "warehouse_id")
        return f
    if family == "purchase_orders":
        delay = F.datediff("actual_delivery_date", "expected_delivery_date")
        f = m.purchase_orders.select(
            "*", delay.alias("delay_days"), F.col("actual_delivery_date").isNotNull().alias("is_delivered"),
            F.coalesce(delay > 0, F.lit(False)).alias("is_late"))
        if _need(keys, "date"):
            f = f.select("*", *_date_attrs(F.col("order_date")))
        if _need(keys, "supplier"):
            f = _related(f, _supplier_dim(m, keys), "supplier_id")
        if _need(keys, "product"):
            f = _related(f, _product_dim(m, keys), "product_id")
        return f
    if family == "supplier_dim":
        return _supplier_dim(m, keys | {"risk_tier"})
    if family == "product_dim":
        return _product_dim(m, keys | {"abc_class"})
    if family == "date_dim":
        from skuflow.plans.star import dim_date
        return dim_date(m)
    raise ValueError(f"unknown family {family}")


def lines_by_product(m: Model, by: list[str]) -> DataFrame:
    """Delivered revenue per (non-product context keys, product), classified afterwards.

    Partial aggregation shrinks the lines to one row per product and context
    before the product dimension (with the ABC class) is joined, so a hot SKU
    never makes a skewed line-level join.
    """
    non_product = [k for k in by if DIM_OF_KEY[k] != "product"]
    f = m.facts.filter(F.col("status") == "Delivered")
    if _need(set(by), "date"):
        f = f.select("*", *_date_attrs(F.col("order_date")))
    group = [k for k in non_product if DIM_OF_KEY[k] == "date"]
    if _need(set(by), "warehouse"):
        group.append("warehouse_id")
    g = f.groupBy(*group, "product_id").agg(money_sum(F.col("quantity") * F.col("price_cents")).alias("rev_c"))
    if _need(set(by), "warehouse"):
        g = _related(g, _warehouse_dim(m), "warehouse_id")
    return _related(g, _product_dim(m, set(by) | {"abc_class"}), "product_id")


def lines_order_grain(m: Model, by: list[str]) -> DataFrame:
    """All-status lines aggregated to (context keys, order, status).

    A line of unknown cost has revenue but no margin. Status is an order attribute, so Delivered-only and all-status measures
    are conditional aggregates over these rows, and order counts are counts
    of rows - one pass over the lines instead of one per status scope.
    """
    f = family_frame(m, "sales_all", set(by))
    aggs = [money_sum(F.col("rev_c")).alias("rev_c"), money_sum(F.col("cogs_c")).alias("cogs_c"),
            money_sum(F.col("rev_c") - F.col("cogs_c")).alias("margin_c"), F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("n_lines")]
    return f.groupBy(*by, "order_id", "status").agg(*aggs)


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        ms = MEASURES[n]
        for dep in ms.needs:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def evaluate(m: Model, measures: list[str] | tuple[str, ...], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Evaluate ``measures`` for every combination of ``by`` present in the data.

    Raises ValueError when a measure's fact has no relationship to a context
    key (the BI model would silently repeat the total there).
    """
    by = list(by)
    keys = set(by)
    unknown = [k for k in by if k not in DIM_OF_KEY]
    if unknown:
        raise ValueError(f"unknown context keys {unknown}")
    order = _closure(list(measures))
    base = [MEASURES[n] for n in order if MEASURES[n].family]
    families: dict[str, list[Measure]] = {}
    for ms in base:
        families.setdefault(ms.family, []).append(ms)
    for fam in families:
        missing = [k for k in by if DIM_OF_KEY[k] not in FAMILY_DIMS[fam]]
        if missing:
            raise ValueError(f"{fam} measures cannot be filtered by {missing}")
    agg_cols = [ms.name for ms in base]
    parts = []
    for fam, ms_list in families.items():
        if fam == "lines":
            f = lines_order_grain(m, by)
        elif fam == "lines_product":
            f = lines_by_product(m, by)
        else:
            f = family_frame(m, fam, keys)
        aggs = [ms.agg().alias(ms.name) for ms in ms_list]
        g = f.groupBy(*by).agg(*aggs) if by else f.agg(*aggs)
        # the other families' columns are NULL in this part
        g = g.select(*by, *[F.col(c) if c in {x.name for x in ms_list}
                            else F.lit(None).cast(_type_of(g, ms_list, c)).alias(c) for c in agg_cols])
        parts.append(g)
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if len(parts) > 1:
        merged = (merged.groupBy(*by).agg(*[F.max(c).alias(c) for c in agg_cols]) if by
                  else merged.agg(*[F.max(c).alias(c) for c in agg_cols]))
    out = merged
    for n in order:
        ms = MEASURES[n]
        if ms.derive is not None:
            out = out.withColumn(n, ms.derive())
    return out.select(*by, *[n for n in measures])


def _type_of(g: DataFrame, ms_list, name: str) -> str:
    # Types of the hidden/public aggregates are known up front; NULL placeholders
    # only need a compatible type, so use the type the measure itself produces.
    return _MEASURE_TYPES.get(name, "double")


_MEASURE_TYPES = {
    "_rev_c": "decimal(38,0)", "_margin_c": "decimal(38,0)", "_cogs_c": "decimal(38,0)",
    "_inv_c": "decimal(38,0)", "_dead_c": "decimal(38,0)", "_a_rev_c": "decimal(38,0)",
    "_lines": "bigint", "_positions": "bigint", "_orders_all": "bigint",
    "total_units_sold": "bigint", "order_count": "bigint", "returned_orders": "bigint",
    "delivered_revenue": "double", "units_on_hand": "bigint", "skus_below_reorder_point": "bigint",
    "purchase_order_count": "bigint", "delivered_pos": "bigint", "late_pos": "bigint",
    "average_delay_days": "double", "high_risk_suppliers": "bigint", "class_a_sku_count": "bigint",
    "selected_period_label": "string",
}


def class_a_share(m: Model, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """M33-M35 with M34's denominator ignoring product filters (DAX ``ALL(dim_product)``).

    The denominator is the revenue aggregated on the non-product keys only and
    joined back (a scalar subquery when there are none) - no window over the
    whole result.
    """
    by = list(by)
    other = [k for k in by if DIM_OF_KEY.get(k) != "product"]
    cur = evaluate(m, ["class_a_revenue", "total_revenue", "class_a_sku_count"], by) if all(
        DIM_OF_KEY.get(k) == "product" for k in by) else evaluate(m, ["class_a_revenue", "total_revenue"], by)
    den = evaluate(m, ["total_revenue"], other).withColumnRenamed("total_revenue", "_all_products_revenue")
    if other:                                                             # a blank member meets its own total
        same = [cur[k].eqNullSafe(den[k]) for k in other]
        cur = cur.join(den, reduce(Column.__and__, same), "left").select(*[cur[c] for c in cur.columns], "_all_products_revenue")
    else:
        cur = cur.withColumn("_all_products_revenue", den.select("_all_products_revenue").scalar())
    return cur.withColumn("class_a_revenue_pct",
                          F.col("class_a_revenue") / F.nullif(F.col("_all_products_revenue"), F.lit(0.0))) \
              .drop("_all_products_revenue")


# Public measures grouped by the family (fact) they are evaluated on.
FAMILY_MEASURES = {
    "lines": ("total_revenue", "total_margin", "total_cogs", "margin_pct", "total_units_sold", "order_count",
              "average_order_value", "lines_per_order", "class_a_revenue"),
    "lines_all": ("returned_orders", "return_rate", "delivered_revenue"),
    "inventory": ("inventory_value", "units_on_hand", "skus_below_reorder_point", "stockout_risk_pct",
                  "dead_stock_value", "dead_stock_pct"),
    "lines+inventory": ("inventory_turnover", "days_of_supply"),
    "purchase_orders": ("purchase_order_count", "delivered_pos", "late_pos", "late_delivery_rate",
                        "on_time_delivery_rate", "average_delay_days"),
    "supplier_dim": ("high_risk_suppliers",),
    "product_dim": ("class_a_sku_count",),
    "date_dim": ("selected_period_label",),
}

# Standard report views: name -> (families, context keys).
MEASURE_VIEWS = {
    "measures_total": (("lines", "lines_all", "inventory", "lines+inventory", "purchase_orders", "supplier_dim",
                        "product_dim", "date_dim"), ()),
    "measures_by_category": (("lines", "lines_all", "inventory", "lines+inventory", "purchase_orders",
                              "product_dim"), ("category",)),
    "measures_by_warehouse": (("lines", "lines_all", "inventory", "lines+inventory"), ("warehouse_name",)),
    "measures_by_year_month": (("lines", "lines_all", "purchase_orders", "date_dim"), ("year_month",)),
    "measures_by_risk_tier": (("purchase_orders", "supplier_dim"), ("risk_tier",)),
}


def view_measures(families) -> list[str]:
    return [n for f in families for n in FAMILY_MEASURES[f]]


def measure_view(m: Model, name: str) -> DataFrame:
    families, by = MEASURE_VIEWS[name]
    return evaluate(m, view_measures(families), list(by))
