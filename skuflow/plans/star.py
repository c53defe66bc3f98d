"""The BI star schema (four dimensions, three facts) and its validation.

Facts keep the grain of their source (one row per line / position / PO) and
carry only keys, flags and additive measures; dimension attributes are looked
up at query time through the relationships in ``RELATIONSHIPS``.  ``publish``
writes the star and runs the checks on what it wrote.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import FISCAL_START_MONTH, date_key, dollars, fiscal_year, round_half_even
from skuflow.operators.abc import classify_cents
from skuflow.operators.detail import line_facts
from skuflow.operators.scorecard import supplier_scorecard
from skuflow.sources.model import Model
from skuflow.session import ensure_checkpoint_dir
from skuflow.sources.schemas import HIDDEN_COLUMNS

# Fixed values of the date dimension: weekend = Sat, Sun (the fiscal year starts in FISCAL_START_MONTH).
WEEKEND_FROM_DAY = 5          # Monday = 0
DEFAULT_ABC_CLASS = "C"
DEFAULT_RISK_TIER = "Insufficient Data"

# Many-to-one, single-direction relationships (fact column -> dimension key).
RELATIONSHIPS = (
    ("fact_sales", "date_key", "dim_date", "date_key"),
    ("fact_sales", "product_id", "dim_product", "product_id"),
    ("fact_sales", "warehouse_id", "dim_warehouse", "warehouse_id"),
    ("fact_inventory", "product_id", "dim_product", "product_id"),
    ("fact_inventory", "warehouse_id", "dim_warehouse", "warehouse_id"),
    ("fact_purchase_orders", "supplier_id", "dim_supplier", "supplier_id"),
    ("fact_purchase_orders", "date_key", "dim_date", "date_key"),
    ("fact_purchase_orders", "product_id", "dim_product", "product_id"),
)
DIM_KEYS = (("dim_date", "date_key"), ("dim_product", "product_id"),
            ("dim_supplier", "supplier_id"), ("dim_warehouse", "warehouse_id"))


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_product: DataFrame
    dim_supplier: DataFrame
    dim_warehouse: DataFrame
    fact_sales: DataFrame
    fact_inventory: DataFrame
    fact_purchase_orders: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def dim_date_between(spark: SparkSession, start, end, fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """One row per calendar day from ``start`` to ``end`` inclusive.

    ``start``/``end`` are dates or date Columns (e.g. scalar subqueries).  The
    table is bounded by the calendar span (about 366 rows a year).
    """
    s = start if isinstance(start, F.Column) else F.lit(start).cast("date")
    e = end if isinstance(end, F.Column) else F.lit(end).cast("date")
    d = F.col("date")
    dow = F.weekday(d)
    return (
        spark.range(1)
        .select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("date"))
        .select(
            "date",
            date_key(d).alias("date_key"),
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMM").alias("month_name"),
            F.date_format(d, "yyyy-MM").alias("year_month"),
            dow.alias("day_of_week"),
            F.date_format(d, "EEE").alias("day_name"),
            (dow >= WEEKEND_FROM_DAY).alias("is_weekend"),
            fiscal_year(d, fiscal_start_month).alias("fiscal_year"),
            F.month(d).alias("month_sort"),
        )
    )


def dim_date(m: Model, fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """D1 over the model: 1 Jan of the first year to 31 Dec of the last year of
    any order or purchase-order date."""
    lo = F.make_date(F.year(m.scalar("min_any_date")), F.lit(1), F.lit(1))
    hi = F.make_date(F.year(m.scalar("max_any_date")), F.lit(12), F.lit(31))
    return dim_date_between(m.spark, lo, hi, fiscal_start_month)


def dim_product(m: Model) -> DataFrame:
    """Products + ABC class (unsold products default to C) + margin %."""
    abc = classify_cents(m).select("product_id", "abc_class")
    price, cost = F.col("unit_price_cents"), F.col("unit_cost_cents")
    return (
        m.products.join(abc, "product_id", "left")
        .select(
            "product_id", "sku", "category",
            dollars(cost).alias("unit_cost"), dollars(price).alias("unit_price"),
            "supplier_id", "reorder_point", "safety_stock",
            F.coalesce("abc_class", F.lit(DEFAULT_ABC_CLASS)).alias("abc_class"),
            round_half_even((F.lit(100) * (price - cost)).cast("double")
                            / F.nullif(price.cast("double"), F.lit(0.0)), 2).alias("margin_pct"),
        )
    )


def dim_supplier(m: Model) -> DataFrame:
    """D3: suppliers + scorecard outcome; the hidden seed column is dropped."""
    sc = supplier_scorecard(m).select("supplier_id", "composite_score", "risk_tier",
                                      "late_delivery_rate_pct", "avg_delay_days")
    return (
        m.suppliers.drop(HIDDEN_COLUMNS["suppliers"])
        .join(sc, "supplier_id", "left")
        .withColumn("risk_tier", F.coalesce("risk_tier", F.lit(DEFAULT_RISK_TIER)))
    )


def dim_warehouse(m: Model) -> DataFrame:
    """D4."""
    return m.warehouses.select("warehouse_id", "name", "region", "capacity_units")


def fact_sales(m: Model) -> DataFrame:
    """Delivered order lines with additive measures and a date key."""
    f = line_facts(m)   # carries the unit cost: no line-level product join
    rev = F.col("line_revenue_cents")
    cogs = F.col("quantity").cast("long") * F.col("unit_cost_cents")
    return f.select(
        "order_line_id", "order_id", "product_id", "warehouse_id", "customer_id", "status", "quantity",
        dollars(F.col("price_cents")).alias("unit_price_at_sale"),
        dollars(rev).alias("line_revenue"),
        dollars(rev - cogs).alias("line_margin"),
        dollars(cogs).alias("line_cogs"),
        date_key(F.col("order_date")).alias("date_key"),
    )


def fact_inventory(m: Model) -> DataFrame:
    """Positions + thresholds + value at cost + the two stock flags."""
    p = m.products.select("product_id", "unit_cost_cents", "reorder_point", "safety_stock")
    on_hand = F.col("quantity_on_hand")
    return m.inventory.join(p, "product_id", "left").select(
        "warehouse_id", "product_id", "quantity_on_hand", "last_restock_date", "reorder_point",
        "safety_stock",
        dollars(on_hand.cast("long") * F.col("unit_cost_cents")).alias("inventory_value"),
        (on_hand < F.col("reorder_point")).alias("is_below_reorder_point"),
        F.greatest(on_hand - F.col("safety_stock"), F.lit(0)).alias("units_above_safety_stock"),
    )


def fact_purchase_orders(m: Model) -> DataFrame:
    """POs + signed delay; ``is_late`` is False (not NULL) while in transit."""
    delay = F.datediff("actual_delivery_date", "expected_delivery_date")
    return m.purchase_orders.select(
        "po_id", "supplier_id", "product_id", "expected_delivery_date", "actual_delivery_date", "quantity",
        delay.alias("delay_days"),
        F.col("actual_delivery_date").isNotNull().alias("is_delivered"),
        F.coalesce(delay > 0, F.lit(False)).alias("is_late"),
        date_key(F.col("order_date")).alias("date_key"),
    )


def build_star(m: Model) -> Star:
    return Star(dim_date=dim_date(m), dim_product=dim_product(m), dim_supplier=dim_supplier(m),
                dim_warehouse=dim_warehouse(m), fact_sales=fact_sales(m),
                fact_inventory=fact_inventory(m), fact_purchase_orders=fact_purchase_orders(m))


def freeze_dimensions(star: Star) -> Star:
    """Compute each dimension once (reliable checkpoint under spark.checkpoint.dir).

    The enriched dimensions (ABC class, risk tier) come from whole analyses;
    a validation reads every dimension several times, and Spark cannot prove
    the enrichment joins are one-to-one, so without this each read would redo
    the analysis.  Dimensions are dimension-sized; facts stay lazy.
    """
    ensure_checkpoint_dir(star.fact_sales.sparkSession)
    t = star.tables()
    for name in ("dim_date", "dim_product", "dim_supplier", "dim_warehouse"):
        t[name] = t[name].checkpoint(eager=True)
    return Star(**t)


def key_tables(m: Model) -> dict[str, DataFrame]:
    """The dimensions' keys as the operational tables have them, without any enrichment."""
    return {"dim_date": dim_date(m).select("date", "date_key"), "dim_product": m.products.select("product_id"),
            "dim_supplier": m.suppliers.select("supplier_id"), "dim_warehouse": m.warehouses.select("warehouse_id")}


def validated_checks(m: Model) -> DataFrame:
    """Q14-Q17 over the model's star schema; keys are compared with the base tables, so no analysis is run for them."""
    return star_checks(build_star(m), key_tables(m))


def _check(spark: SparkSession, name: str, passed: F.Column | bool, detail: F.Column | str,
           source: DataFrame | None = None) -> DataFrame:
    """One-row (check, passed, detail) frame; ``source`` is an aggregate producing the columns."""
    base = source if source is not None else spark.range(1)
    p = passed if isinstance(passed, F.Column) else F.lit(bool(passed))
    d = detail if isinstance(detail, F.Column) else F.lit(detail)
    return base.select(F.lit(name).alias("check"), p.alias("passed"), d.alias("detail"))


def key_resolution(star: Star, keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """Q14: one row per relationship with the number of fact keys missing in the dimension.

    Each fact is scanned once: its foreign-key columns are exploded into
    (relation, key) pairs and reduced to distinct keys (partial aggregation),
    then one anti-join against the tagged dimension keys finds the orphans -
    the join sees key sets, not fact rows.
    """
    t = star.tables() | (keys or {})
    spark = star.fact_sales.sparkSession
    number = {rel: i for i, rel in enumerate(RELATIONSHIPS)}          # a hash table of numbers, not of names
    fact_keys = []
    for fact in dict.fromkeys(r[0] for r in RELATIONSHIPS):
        pairs = [F.struct(F.lit(number[r]).alias("i"), F.col(r[1]).cast("long").alias("k"))
                 for r in RELATIONSHIPS if r[0] == fact]
        fact_keys.append(t[fact].select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
                         .filter(F.col("k").isNotNull()).distinct())
    # each dimension is read once; its key is tagged for every relation that uses it
    dim_keys = []
    for dim in dict.fromkeys(r[2] for r in RELATIONSHIPS):
        tags = [F.struct(F.lit(number[r]).alias("i"), F.col(r[3]).cast("long").alias("k"))
                for r in RELATIONSHIPS if r[2] == dim]
        dim_keys.append(t[dim].select(F.explode(F.array(*tags)).alias("p")).select("p.*"))
    orphans = (reduce(DataFrame.unionByName, fact_keys)
               .join(reduce(DataFrame.unionByName, dim_keys), ["i", "k"], "left_anti")
               .groupBy("i").agg(F.count(F.lit(1)).alias("n")))
    names = spark.createDataFrame([(f"{r[0]}.{r[1]} resolves", i) for r, i in number.items()], "check string, i int")
    return (names.join(orphans, "i", "left")
            .select("check", (F.coalesce("n", F.lit(0)) == 0).alias("passed"),
                    F.format_string("%d unresolved keys", F.coalesce("n", F.lit(0))).alias("detail")))


def star_checks(star: Star, keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """Q14-Q17: key resolution, date contiguity, key uniqueness, no hidden columns.

    ``keys`` may give other tables of the dimensions' keys than the dimensions themselves.
    Every check is an aggregate (anti-join counts, distinct counts), so the
    union is computed on executors and only one row per check is produced.
    """
    shown = star.tables()
    t = shown | (keys or {})
    spark = star.fact_sales.sparkSession
    checks = [key_resolution(star, keys)]
    span = t["dim_date"].agg(F.min("date").alias("lo"), F.max("date").alias("hi"),
                             F.countDistinct("date").alias("days"), F.count(F.lit(1)).alias("rows"))
    checks.append(_check(
        spark, "dim_date is contiguous",
        (F.datediff("hi", "lo") + 1 == F.col("days")) & (F.col("days") == F.col("rows")),
        F.format_string("%d rows over %d days", F.col("rows"), F.datediff("hi", "lo") + 1), span))
    for dim, key in DIM_KEYS:
        u = t[dim].agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("keys"))
        checks.append(_check(spark, f"{dim}.{key} is unique", F.col("rows") == F.col("keys"),
                             F.format_string("%d rows, %d keys", F.col("rows"), F.col("keys")), u))
    leaked = [c for tbl, c in (("dim_product", HIDDEN_COLUMNS["products"]),
                               ("dim_supplier", HIDDEN_COLUMNS["suppliers"])) if c in shown[tbl].columns]
    checks.append(_check(spark, "hidden columns are absent", not leaked,
                         ", ".join(leaked) if leaked else "none"))
    return reduce(DataFrame.unionByName, checks)


def date_gaps(dim: DataFrame) -> DataFrame:
    """Dates whose gap to the previous date is not one day (empty when contiguous).

    The window is ordered over the date dimension itself - one row per
    calendar day, bounded by the calendar span, not by the facts.
    """
    w = Window.orderBy("date")
    return (dim.select("date", F.datediff("date", F.lag("date").over(w)).alias("gap_days"))
            .filter(F.col("gap_days").isNotNull() & (F.col("gap_days") != 1)))


def verdict(checks: DataFrame) -> DataFrame:
    """Q18: overall verdict row (all checks passed?)."""
    return checks.agg(F.every("passed").alias("all_passed"),
                      F.count_if(~F.col("passed")).alias("failed_checks"),
                      F.count(F.lit(1)).alias("checks"))


def assert_valid(checks: DataFrame) -> None:
    """Fail loudly (Q18) - only the one-row verdict reaches the driver."""
    row = verdict(checks).first()
    if not row["all_passed"]:
        bad = [r["check"] for r in checks.filter(~F.col("passed")).select("check").collect()]
        raise RuntimeError(f"validation failed: {bad}")
