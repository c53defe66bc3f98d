"""Q1-Q13, Q19-Q24: data-quality checks as queries.

Each check yields rows ``(check, passed, detail)``; every row is produced by
an aggregate that runs on executors (conditional counts, anti-join counts,
distinct counts), so only one small row per check ever exists.  Checks over
one table share one pass (a single ``agg`` with many conditional counts,
unpivoted with ``stack``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import money_sum, pearson, round_half_even
from skuflow.operators.prefix import running_totals
from skuflow.operators.questions import dead_stock_value, warehouse_totals
from skuflow.sources.model import Model
from skuflow.sources.schemas import MODEL_SCHEMAS, ORDER_STATUSES

# Keys and constraints of the operational schema.
PRIMARY_KEYS = (
    ("warehouses", ("warehouse_id",)), ("suppliers", ("supplier_id",)), ("products", ("product_id",)),
    ("products", ("sku",)), ("inventory", ("warehouse_id", "product_id")), ("purchase_orders", ("po_id",)),
    ("orders", ("order_id",)), ("order_lines", ("order_line_id",)),
)
FOREIGN_KEYS = (
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inventory", "warehouse_id", "warehouses", "warehouse_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("purchase_orders", "supplier_id", "suppliers", "supplier_id"),
    ("purchase_orders", "product_id", "products", "product_id"),
    ("orders", "warehouse_id", "warehouses", "warehouse_id"),
    ("order_lines", "order_id", "orders", "order_id"),
    ("order_lines", "product_id", "products", "product_id"),
)
CHECK_CONSTRAINTS = {
    "warehouses": (("capacity_units > 0", "capacity_units > 0"),),
    "suppliers": (("base_reliability_score between 0 and 1", "base_reliability_score BETWEEN 0 AND 1"),
                  ("avg_lead_time_days > 0", "avg_lead_time_days > 0")),
    "products": (("unit_cost > 0", "unit_cost_cents > 0"), ("unit_price > 0", "unit_price_cents > 0"),
                 ("unit_price >= unit_cost", "unit_price_cents >= unit_cost_cents"),
                 ("reorder_point >= 0", "reorder_point >= 0"), ("safety_stock >= 0", "safety_stock >= 0")),
    "inventory": (("quantity_on_hand >= 0", "quantity_on_hand >= 0"),),
    "purchase_orders": (("quantity > 0", "quantity > 0"),),
    "order_lines": (("quantity > 0", "quantity > 0"), ("unit_price_at_sale > 0", "price_cents > 0")),
}
BANDS = {"on_time": (0.75, 0.97), "stockout": (0.08, 0.16), "dead": (0.06, 0.14), "top20": 0.55}
ABC_LABELS = ("A", "B", "C")
RISK_LABELS = ("Preferred", "Monitor", "High Risk", "Insufficient Data")
DEFAULT_ORDER_WINDOW = ("1995-01-01", "2001-12-31")


def _rows(df: DataFrame, name: Column, passed: Column, detail: Column) -> DataFrame:
    return df.select(name.alias("check"), passed.alias("passed"), detail.alias("detail"))


def _stack(agg: DataFrame, labels: list[str], prefix: str, detail_fmt: str) -> DataFrame:
    """Unpivot one wide row of violation counts into (check, passed, detail) rows."""
    pairs = ", ".join(f"'{lbl}', `c{i}`" for i, lbl in enumerate(labels))
    long = agg.selectExpr(f"stack({len(labels)}, {pairs}) AS (label, n)")
    return _rows(long, F.concat(F.lit(prefix), F.col("label")), F.col("n") == 0,
                 F.format_string(detail_fmt, F.col("n")))


def pk_checks(m: Model) -> DataFrame:
    """Q1: primary / unique keys (duplicates and NULL keys both fail).

    One pipeline per key: rows are counted per key value (partial
    aggregation), then the per-key counts are summarised - NULL keys form
    their own group, so no second pass or join is needed.
    """
    parts = []
    for table, keys in PRIMARY_KEYS:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        per_key = m.table(table).groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
        summary = per_key.agg(
            F.count_if(~any_null & (F.col("c") > 1)).alias("d"),
            F.coalesce(F.sum(F.when(any_null, F.col("c"))), F.lit(0).cast("long")).alias("z"))
        label = f"{table}({', '.join(keys)}) is unique"
        parts.append(_rows(summary, F.lit(label), (F.col("d") == 0) & (F.col("z") == 0),
                           F.format_string("%d duplicate keys, %d null keys", F.col("d"), F.col("z"))))
    return reduce(DataFrame.unionByName, parts)


def not_null_checks(m: Model) -> DataFrame:
    """Q2: every NOT NULL column of the declared schema, one pass per table."""
    parts = []
    for table, schema in MODEL_SCHEMAS.items():
        cols = [f.name for f in schema.fields if not f.nullable]
        agg = m.table(table).agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
        parts.append(_stack(agg, cols, f"{table}.", "%d nulls").withColumn(
            "check", F.concat(F.col("check"), F.lit(" is not null"))))
    return reduce(DataFrame.unionByName, parts)


def check_constraints(m: Model) -> DataFrame:
    """Q3 / Q8: CHECK ranges, positivity and price >= cost; one pass per table."""
    parts = []
    for table, rules in CHECK_CONSTRAINTS.items():
        agg = m.table(table).agg(*[F.count_if(~F.expr(expr)).alias(f"c{i}") for i, (_, expr) in enumerate(rules)])
        parts.append(_stack(agg, [lbl for lbl, _ in rules], f"{table}: ", "%d violations"))
    return reduce(DataFrame.unionByName, parts)


def domain_checks(m: Model) -> DataFrame:
    """Q4: order status within its domain."""
    agg = m.orders.agg(F.count_if(~F.col("status").isin(*ORDER_STATUSES) | F.col("status").isNull()).alias("n"))
    return _rows(agg, F.lit("orders.status in domain"), F.col("n") == 0,
                 F.format_string("%d violations", F.col("n")))


def _orphans(m: Model, child: str, col: str, parent: str, key: str) -> DataFrame:
    return (m.table(child).filter(F.col(col).isNotNull())
            .join(m.table(parent).select(F.col(key).alias(col)), col, "left_anti"))


def fk_checks(m: Model) -> DataFrame:
    """Q5: the eight foreign keys.

    Per relation the child's key column is counted per key (partial aggregation)
    and anti-joined with the one parent it references; orphan rows are the summed
    counts.  The join sees distinct keys, not child rows.
    """
    parts = []
    for child, col, parent, key in FOREIGN_KEYS:
        rows = (m.table(child).filter(F.col(col).isNotNull())
                .groupBy(F.col(col).cast("long").alias("k")).agg(F.count(F.lit(1)).alias("rows")))
        known = m.table(parent).select(F.col(key).cast("long").alias("k"))
        n = rows.join(known, "k", "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("n"))
        parts.append(_rows(n, F.lit(f"{child}.{col} references {parent}"), F.col("n") == 0,
                           F.format_string("%d orphans", F.col("n"))))
    return reduce(DataFrame.unionByName, parts)


def fk_violation_sample(m: Model, n: int = 10) -> DataFrame:
    """Q6: up to ``n`` orphan keys per relation (lowest keys first)."""
    parts = []
    for child, col, parent, key in FOREIGN_KEYS:
        o = _orphans(m, child, col, parent, key).select(
            F.lit(f"{child}.{col}").alias("relation"), F.col(col).cast("long").alias("key")).distinct()
        parts.append(o.orderBy("key").limit(n))
    return reduce(DataFrame.unionByName, parts)


def assert_references(m: Model, n: int = 10) -> None:
    """Raise when a foreign key is broken, naming up to ``n`` orphan keys per relation."""
    found = fk_violation_sample(m, n).collect()
    if found:
        raise ValueError("broken references: " + ", ".join(f"{r['relation']} = {r['key']}" for r in found))


def row_count_checks(m: Model, expected: dict[str, int | Column] | None = None) -> DataFrame:
    """Q7: row count per table against an expectation (literal or scalar Column)."""
    parts = []
    for table, exp in (expected or {}).items():
        e = exp if isinstance(exp, Column) else F.lit(int(exp)).cast("long")
        c = m.table(table).agg(F.count(F.lit(1)).alias("n")).withColumn("e", e)
        parts.append(_rows(c, F.lit(f"{table} has expected row count"), F.col("n") == F.col("e"),
                           F.format_string("%d of %d", F.col("n"), F.col("e"))))
    return reduce(DataFrame.unionByName, parts)


def date_window_check(m: Model, start: str = DEFAULT_ORDER_WINDOW[0], end: str = DEFAULT_ORDER_WINDOW[1]) -> DataFrame:
    """Q9: every order date inside [start, end]."""
    a = m.orders.agg(F.count_if(~F.col("order_date").between(F.lit(start).cast("date"),
                                                             F.lit(end).cast("date"))).alias("n"))
    return _rows(a, F.lit("orders dated inside the expected window"), F.col("n") == 0,
                 F.format_string("%d outside", F.col("n")))


def _share_row(agg: DataFrame, name: str, share: Column, lo: float, hi: float | None) -> DataFrame:
    ok = (share >= lo) & (share <= hi) if hi is not None else (share >= lo)
    return _rows(agg, F.lit(name), F.coalesce(ok, F.lit(False)),
                 F.format_string("got %.1f%%", round_half_even(share * 100, 1)))


def on_time_share(m: Model, band: tuple[float, float] = BANDS["on_time"]) -> DataFrame:
    """Q10: 1 - mean(actual > expected) over delivered POs, band 0.75-0.97."""
    a = m.purchase_orders.filter(F.col("actual_delivery_date").isNotNull()).agg(
        F.count_if(F.col("actual_delivery_date") > F.col("expected_delivery_date")).alias("late"),
        F.count(F.lit(1)).alias("n"))
    share = F.lit(1.0) - F.col("late").cast("double") / F.nullif(F.col("n").cast("double"), F.lit(0.0))
    lo, hi = band
    return _share_row(a, "on-time share of delivered purchase orders within its band", share, lo, hi)


def _positions(m: Model) -> DataFrame:
    p = m.products.select("product_id", "reorder_point", "safety_stock")
    return m.inventory.join(p, "product_id")


def stockout_share(m: Model, band: tuple[float, float] = BANDS["stockout"]) -> DataFrame:
    """Q11: share of positions below the reorder point, band 0.08-0.16."""
    a = _positions(m).agg(F.count_if(F.col("quantity_on_hand") < F.col("reorder_point")).alias("k"),
                          F.count(F.lit(1)).alias("n"))
    lo, hi = band
    return _share_row(a, "share of positions under the reorder point within its band",
                      F.col("k").cast("double") / F.nullif(F.col("n").cast("double"), F.lit(0.0)), lo, hi)


def dead_share(m: Model, band: tuple[float, float] = BANDS["dead"]) -> DataFrame:
    """Q12: share of positions with on hand >= 4 x safety stock, band 0.06-0.14."""
    a = _positions(m).agg(F.count_if(F.col("quantity_on_hand") >= F.col("safety_stock") * 4).alias("k"),
                          F.count(F.lit(1)).alias("n"))
    lo, hi = band
    return _share_row(a, "share of dead positions within its band",
                      F.col("k").cast("double") / F.nullif(F.col("n").cast("double"), F.lit(0.0)), lo, hi)


def top20_share(m: Model, least: float = BANDS["top20"]) -> DataFrame:
    """Q13: revenue share of the top max(1, floor(0.2 n)) products, all statuses, >= 0.55."""
    per = m.order_lines.groupBy("product_id").agg(
        money_sum(F.col("quantity") * F.col("price_cents")).alias("rev"))
    ranked = running_totals(per, [("rev", True), ("product_id", False)], "rev",
                            total_col="total", count_col="n")
    cutoff = F.greatest(F.lit(1), F.floor(F.col("n") * 0.2))
    a = ranked.agg(F.sum(F.when(F.col("rank") <= cutoff, F.col("rev"))).alias("top"),
                   F.max("total").alias("total"))
    share = F.col("top").cast("double") / F.nullif(F.col("total").cast("double"), F.lit(0.0))
    return _share_row(a, "revenue share of the best fifth of products reaches its band", share, least, None)


def po_date_check(m: Model) -> DataFrame:
    """Q19: a delivered PO never arrives before it was ordered."""
    a = m.purchase_orders.agg(F.count_if(F.col("actual_delivery_date") < F.col("order_date")).alias("n"))
    return _rows(a, F.lit("delivered POs arrive on or after the order date"), F.col("n") == 0,
                 F.format_string("%d violations", F.col("n")))


def exact_median_date(dates: DataFrame, col: str) -> Column:
    """Exact median of a date column as fractional epoch days (scalar subquery).

    Counts per distinct day (bounded by the calendar, not the data), a running
    count over those days, then the middle one or two values - no row-level
    buffer, no sampling.
    """
    per_day = dates.groupBy(F.unix_date(F.col(col)).alias("d")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy("d")  # one row per calendar day
    cum = per_day.select("d", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                         F.sum("c").over(Window.partitionBy(F.lit(0))).alias("n"))
    lo_k = F.floor((F.col("n") + 1) / 2)
    hi_k = F.ceil((F.col("n") + 1) / 2)
    picks = cum.agg(F.min(F.when(F.col("cum") >= lo_k, F.col("d"))).alias("lo"),
                    F.min(F.when(F.col("cum") >= hi_k, F.col("d"))).alias("hi"))
    return picks.select((F.col("lo") + F.col("hi")) / F.lit(2.0)).scalar()


def basket_stability(m: Model, tolerance: float = 0.4) -> DataFrame:
    """Q20: mean lines per order before vs from the median order date differ by < tolerance."""
    lines = m.order_lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    med = exact_median_date(m.orders, "order_date")
    o = m.orders.join(lines, "order_id", "left").withColumn(
        "second", F.unix_date("order_date").cast("double") >= med)
    a = o.agg(F.avg(F.when(~F.col("second"), F.col("n_lines"))).alias("first_mean"),
              F.avg(F.when(F.col("second"), F.col("n_lines"))).alias("second_mean"))
    gap = F.abs(F.col("first_mean") - F.col("second_mean"))
    return _rows(a, F.lit("lines per order is stable over time"), F.coalesce(gap < tolerance, F.lit(False)),
                 F.format_string("first %.3f, second %.3f", round_half_even(F.col("first_mean"), 3),
                                 round_half_even(F.col("second_mean"), 3)))


def month_basket_corr(m: Model, limit: float = 0.05) -> DataFrame:
    """Q21: order month and basket size are independent, |r| < limit."""
    per_order = m.facts.groupBy("order_id", "order_date").agg(F.count(F.lit(1)).alias("n_lines"))
    o = per_order.select(
        (F.year("order_date") * 12 + F.month("order_date")).alias("mi"), F.col("n_lines").alias("nl"))
    a = o.agg(round_half_even(pearson(F.col("mi"), F.col("nl")), 3).alias("r"))
    return _rows(a, F.lit("order month and basket size are independent"),
                 F.coalesce(F.abs(F.col("r")) < limit, F.lit(False)), F.format_string("r = %.3f", F.col("r")))


def revenue_reconcile(m: Model) -> DataFrame:
    """Q22: warehouse report revenue equals raw line revenue, in exact cents."""
    report = warehouse_totals(m).agg(F.sum("revenue_cents").alias("r"))
    raw = m.order_lines.agg(money_sum(F.col("quantity") * F.col("price_cents"))).scalar()
    return _rows(report.withColumn("t", raw), F.lit("warehouse revenue reconciles with order lines"),
                 F.col("r") == F.col("t"),
                 F.format_string("report %s, lines %s", F.col("r").cast("string"), F.col("t").cast("string")))


def dead_reconcile(m: Model) -> DataFrame:
    """Q23: dead-stock units in the report equal the recount from base tables."""
    report = dead_stock_value(m).agg(F.sum("total_units_tied_up").alias("r"))
    raw = _positions(m).filter(F.col("quantity_on_hand") >= F.col("safety_stock") * 4) \
                       .agg(F.sum("quantity_on_hand").cast("long")).scalar()
    return _rows(report.withColumn("t", raw), F.lit("dead-stock units reconcile with inventory"),
                 F.col("r") == F.col("t"), F.format_string("report %d, inventory %d", F.col("r"), F.col("t")))


def label_checks(dim_product: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    """Q24: ABC and risk-tier labels within their allowed sets (NULL fails)."""
    a = dim_product.agg(F.count_if(~F.coalesce(F.col("abc_class").isin(*ABC_LABELS), F.lit(False))).alias("n"))
    b = dim_supplier.agg(F.count_if(~F.coalesce(F.col("risk_tier").isin(*RISK_LABELS), F.lit(False))).alias("n"))
    return _rows(a, F.lit("abc_class labels valid"), F.col("n") == 0,
                 F.format_string("%d invalid", F.col("n"))).unionByName(
        _rows(b, F.lit("risk_tier labels valid"), F.col("n") == 0, F.format_string("%d invalid", F.col("n"))))


def expected_counts_from_sources(m: Model, src: dict[str, DataFrame]) -> dict[str, Column]:
    """Q7 expectations for the TPC-H binding: one model row per source row."""
    cnt = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return {"warehouses": cnt(src["region"]), "suppliers": cnt(src["supplier"]),
            "products": cnt(src["part"]), "orders": cnt(src["orders"])}


def generation_report(m: Model, expected: dict | None = None, bands: dict | None = None,
                      window: tuple[str, str] = DEFAULT_ORDER_WINDOW) -> DataFrame:
    """The 22-check data-generation gate: counts, integrity, signs, window, bands (``BANDS`` where none is given)."""
    bands = BANDS | (bands or {})
    parts = []
    if expected:
        parts.append(row_count_checks(m, expected))
    parts += [fk_checks(m), check_constraints(m), date_window_check(m, *window), on_time_share(m, bands["on_time"]),
              stockout_share(m, bands["stockout"]), dead_share(m, bands["dead"]), top20_share(m, bands["top20"])]
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame) -> DataFrame:
    """Q18 over any check list."""
    return checks.agg(F.every("passed").alias("all_passed"),
                      F.count_if(~F.col("passed")).alias("failed_checks"),
                      F.count(F.lit(1)).alias("checks"))
