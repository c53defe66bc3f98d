"""Many filter contexts from one scan, with distinct counts that merge (A4, M6, M9, A18 with §2.13).

A count of distinct orders does not add up over parts of a context, so it usually costs one pass
per context. Here the lines are dealt once by order, each line as its order, status and context
keys. What an order adds to a context is then known from its own few rows: it counts once in each
context that one of its lines falls into, in total and for its status. Orders turn into such marks
within their task, and marks are counted by context with partial aggregation, so one shuffle serves
all contexts. Sums of money are exact decimals over grouping sets: the groups are the sum of the
contexts' sizes, not their product.

Contexts are made of keys of a bounded number of values (``BOUNDED_KEYS``), so an order has a bounded
number of rows; ``approximate=True`` keeps one sketch per context (``hll_sketch_agg``) instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.exprs import EXACT
from skuflow.operators.abc import classify_cents
from skuflow.plans.measures import BOUNDED_KEYS, DIM_OF_KEY, FAMILY_DIMS, MEASURES, family_frame
from skuflow.session import dealt
from skuflow.sources.model import Model

#: Measures of the sales facts that one scan gives.
LINE_MEASURES = ("total_revenue", "total_margin", "total_cogs", "margin_pct", "total_units_sold", "order_count", "average_order_value",
                 "lines_per_order", "returned_orders", "return_rate", "delivered_revenue", "class_a_revenue")
_SUMS = ("_rev_c", "_cogs_c", "_margin_c", "total_units_sold", "_lines", "_a_rev_c")
_ORDERS = {"order_count": "Delivered", "returned_orders": "Returned", "_orders_all": None}


def _checked(contexts: Sequence[Sequence[str]]) -> list[list[str]]:
    out = [list(c) for c in contexts]
    bad = sorted({k for c in out for k in c if k not in BOUNDED_KEYS or DIM_OF_KEY[k] not in FAMILY_DIMS["lines"]})
    if bad:
        raise ValueError(f"one scan cannot be split by {bad}; use measures.evaluate")
    return out


def _sums() -> list[Column]:
    sold = F.col("status") == "Delivered"
    return [F.sum(F.when(sold, F.col("rev_c").cast(EXACT))).alias("_rev_c"), F.sum(F.when(sold, F.col("cogs_c").cast(EXACT))).alias("_cogs_c"),
            F.sum(F.when(sold, (F.col("rev_c") - F.col("cogs_c")).cast(EXACT))).alias("_margin_c"), F.sum(F.when(sold, F.col("quantity").cast("long"))).alias("total_units_sold"),
            F.nullif(F.count_if(sold), F.lit(0).cast("long")).alias("_lines"), F.sum(F.when(sold & F.col("best"), F.col("rev_c").cast(EXACT))).alias("_a_rev_c")]


def _sketches() -> list[Column]:
    """A sketch of the distinct orders of each status."""
    return [F.hll_sketch_agg(F.col("order_id") if status is None else F.when(F.col("status") == status, F.col("order_id"))).alias(name)
            for name, status in _ORDERS.items()]


def _gid(context: Sequence[str], keys: Sequence[str]) -> int:
    """The grouping id of a context: a bit for each key that it lacks, the first key's highest."""
    return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in context)


def _mark(gid: int, context: Sequence[str], lines: DataFrame, keys: Sequence[str], by_status: bool) -> Callable[[Column], Column]:
    """What a line's order counts for in a context, in total or by status."""
    def mark(line: Column) -> Column:
        named = [(line[k] if k in context else F.lit(None).cast(lines.schema[k].dataType)).alias(k) for k in keys]
        return F.struct(F.lit(gid).cast("long").alias("gid"), *named, (line["status"] if by_status else F.lit(None).cast("string")).alias("for_status"))
    return mark


def _order_marks(m: Model, lines: DataFrame, contexts: Sequence[Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """One row per context, combination of its keys, order and status, and one for the order in total (for_status is NULL).

    The lines are dealt by order before anything is grouped, so grouping them moves nothing more.
    """
    orders = lines.select("order_id", F.struct("status", *keys).alias("line"))
    orders = dealt(orders, (m.stats or {}).get("line_count", 0), "order_id").groupBy("order_id").agg(F.collect_set("line").alias("lines"))
    counted = F.filter("lines", lambda line: line["status"].isin(*[s for s in _ORDERS.values() if s is not None]))
    marks = []
    for gid, context in {_gid(c, keys): c for c in contexts}.items():
        marks += [F.array_distinct(F.transform(F.col("lines"), _mark(gid, context, lines, keys, False))),
                  F.array_distinct(F.transform(counted, _mark(gid, context, lines, keys, True)))]
    return orders.select("order_id", F.explode(F.concat(*marks)).alias("m")).select("order_id", "m.*")


def _exact_counts() -> list[Column]:
    """Over the marks of a context; marks of lines without an order id count for nothing."""
    known = F.col("order_id").isNotNull()
    return [F.count_if(known & (F.col("for_status").isNull() if status is None else F.coalesce(F.col("for_status") == status, F.lit(False)))).alias(name)
            for name, status in _ORDERS.items()]


def line_measures(m: Model, contexts: Sequence[Sequence[str]], approximate: bool = False) -> DataFrame:
    """``LINE_MEASURES`` of every context from one scan of the line facts for sums and one for orders.

    One row per context and combination of its keys: context (the keys' names, joined by a comma;
    empty for the grand total), the keys of all contexts (NULL where a context lacks one, and for a
    blank member), the measures. The same values as ``measures.evaluate`` context by context.
    """
    contexts = _checked(contexts)
    keys = list(dict.fromkeys(k for c in contexts for k in c))
    # The ids of class A are looked up first, on the columns of the facts that the measures read. They are
    # the smaller side by far: a hash table of a partition's ids spares the sort of its lines.
    best = classify_cents(m).where("abc_class = 'A'").select(F.col("product_id").alias("_best")).hint("shuffle_hash")
    facts = m.facts.select("order_id", "product_id", "status", "quantity", "price_cents", "unit_cost_cents", "product_category", "order_date", "warehouse_id")
    if not approximate:                                                   # sums are those of delivered lines, orders are counted from all lines
        facts = facts.where(F.col("status") == "Delivered")
    facts = facts.join(best, F.col("product_id") == F.col("_best"), "left").withColumn("best", F.col("_best").isNotNull()).drop("_best")
    lines = family_frame(replace(m, line_facts=facts), "sales_all", set(keys)).select(*keys, "order_id", "status", "quantity", "rev_c", "cogs_c", "best")
    names = {_gid(c, keys): ",".join(c) for c in contexts}
    label = F.lit(None).cast("string")
    for gid, name in names.items():
        label = F.when(F.col("gid") == gid, F.lit(name)).otherwise(label)
    aggs = [*_sums(), *(_sketches() if approximate else [])]
    if keys:
        whole = lines.groupingSets(list({_gid(c, keys): c for c in contexts}.values()), *keys).agg(F.grouping_id().alias("gid"), *aggs)
    else:
        whole = lines.groupBy(F.lit(0).cast("long").alias("gid")).agg(*aggs)
    if approximate:
        whole = whole.withColumns({c: F.hll_sketch_estimate(c) for c in _ORDERS})
    else:
        marks = _order_marks(m, family_frame(m, "sales_all", set(keys)), contexts, keys)
        orders = marks.groupBy("gid", *keys).agg(*_exact_counts())
        both = whole.unionByName(orders, allowMissingColumns=True)
        whole = both.groupBy("gid", *keys).agg(*[F.sum(c).alias(c) for c in (*_SUMS, *_ORDERS)])
    whole = whole.withColumn("order_count", F.nullif("order_count", F.lit(0).cast("long"))).withColumn("delivered_revenue", F.col("_rev_c").cast("double") / F.lit(100))
    for name in LINE_MEASURES:
        if MEASURES[name].derive is not None:
            whole = whole.withColumn(name, MEASURES[name].derive())
    return whole.select(label.alias("context"), *keys, *LINE_MEASURES)


def order_counts(m: Model, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct orders of every subtotal of ``keys`` (all statuses, delivered, returned) from one scan."""
    subtotals = [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)]
    _checked(subtotals)
    lines = family_frame(m, "sales_all", set(keys)).select(*keys, "order_id", "status")
    if approximate:
        whole = lines.groupingSets(subtotals, *keys).agg(F.grouping_id().alias("gid"), *_sketches()).withColumns({c: F.hll_sketch_estimate(c) for c in _ORDERS})
    else:
        whole = _order_marks(m, lines, subtotals, keys).groupBy("gid", *keys).agg(*_exact_counts())
    flags = [F.shiftright("gid", len(keys) - 1 - i).bitwiseAND(F.lit(1)).cast("int").alias(f"all_{k}") for i, k in enumerate(keys)]
    return whole.select(*keys, *flags, F.col("_orders_all").alias("orders"), F.col("order_count").alias("delivered_orders"), "returned_orders")


#: Contexts of the standard views that split sales.
STANDARD = ((), ("category",), ("warehouse_name",), ("year_month",), ("warehouse_name", "category"))


def standard_line_measures(m: Model) -> DataFrame:
    return line_measures(m, STANDARD)
