"""Derive the operational model from the driver's TPC-H-like tables.

The mapping is fixed by FIXTURES.md part B; every column is a deterministic
expression of the source rows.  All heavy work is aggregation with partial
(map-side) combine; the only window is the per-order line numbering, whose
partitions are single orders.  Lookups of tiny fixed dimensions (region,
nation) are left to Spark's size-checked auto-broadcast.
"""

from __future__ import annotations

import hashlib
import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


from skuflow.sources.model import LINE_FACT_COLUMNS, Model

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the binding (FIXTURES.md part B).
STATUS_OF_ORDERSTATUS = {"F": "Delivered", "P": "Returned", "O": "Cancelled"}
LEAD_TIME_BASE, LEAD_TIME_STEP, LEAD_TIME_CYCLE = 60, 20, 14
COST_PER_LIST_DOLLAR_CENTS = 73     # cost_cents = round(73 * retail price)
CAPACITY_PER_WAREHOUSE = 100000


def read_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    # Footer/schema reads are independent driver round trips: do them together.
    with ThreadPoolExecutor(max_workers=len(SOURCE_TABLES)) as pool:
        frames = pool.map(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"), SOURCE_TABLES)
        return dict(zip(SOURCE_TABLES, frames))


def _lead_time(supplier_id):
    return (F.lit(LEAD_TIME_BASE) + F.lit(LEAD_TIME_STEP) * (supplier_id % LEAD_TIME_CYCLE)).cast("int")


def _reliability_m(supplier_id):
    return F.greatest(supplier_id % 10 - 5, F.lit(0))


_BOUND: dict[tuple[str, str, bool], Model] = {}

#: Seconds for which a session takes the sources as unchanged without looking again.
SOURCE_CHECK_SECONDS = 60
_VERSIONS: dict[tuple[str, str], tuple[float, str]] = {}


def source_version(spark: SparkSession, sf_dir: str, refresh: bool = False) -> str:
    """Names, sizes and times of the source tables' files, so that rewritten ones are noticed.

    The files of the seven tables are listed, nothing else below ``sf_dir``, and at most once in
    SOURCE_CHECK_SECONDS of a session, unless ``refresh`` is set.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    seen = _VERSIONS.get(key)
    if seen and not refresh and time.monotonic() - seen[0] < SOURCE_CHECK_SECONDS:
        return seen[1]
    fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    mark = hashlib.sha256()
    for table in SOURCE_TABLES:
        path = fs_path(f"{sf_dir}/{table}.parquet")
        files = path.getFileSystem(conf).listStatus(path)                 # of a file: itself
        for line in sorted(f"{table}/{f.getPath().getName()}/{f.getLen()}/{f.getModificationTime()}" for f in files):
            mark.update(line.encode() + b"\n")
    _VERSIONS[key] = (time.monotonic(), mark.hexdigest())
    return _VERSIONS[key][1]


def bind(spark: SparkSession, sf_dir: str, cache: bool = True, materialize: bool | None = None, refresh: bool = False) -> Model:
    """The model over ``sf_dir``, shared by every query of the same application.

    With ``materialize`` (default: on unless SKUFLOW_LAZY_MODEL=1) the model is
    loaded once - every binding stage written as Parquet under the cluster's
    checkpoint directory and read back - like the reference's load-then-query
    pipeline.  Otherwise it stays a purely lazy plan over the sources.
    ``refresh`` looks at the sources again, whenever they were last looked at.
    """
    if materialize is None:
        materialize = os.environ.get("SKUFLOW_LAZY_MODEL", "0") != "1"
    key = (spark.sparkContext.applicationId, sf_dir, source_version(spark, sf_dir, refresh), materialize)
    if cache and key in _BOUND:
        return _BOUND[key]
    if materialize:
        from skuflow.sources.load import load_model
        model = load_model(spark, sf_dir)
    else:
        model = bind_frames(read_sources(spark, sf_dir))
    if cache:
        _BOUND[key] = model
    return model


def _warehouses(src: dict[str, DataFrame]) -> DataFrame:
    return src["region"].select(
        F.col("r_regionkey").cast("long").alias("warehouse_id"),
        F.col("r_name").alias("name"),
        F.col("r_name").alias("region"),
        (F.lit(CAPACITY_PER_WAREHOUSE) * (F.col("r_regionkey") + 1)).cast("int").alias("capacity_units"),
    )


def _orders(src: dict[str, DataFrame]) -> DataFrame:
    status = F.lit(None).cast("string")
    for code, label in STATUS_OF_ORDERSTATUS.items():
        status = F.when(F.col("o_orderstatus") == code, F.lit(label)).otherwise(status)
    return (
        src["orders"].join(src["customer"].select("c_custkey", "c_nationkey"),
                           F.col("o_custkey") == F.col("c_custkey"))
        .join(src["nation"].select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("long").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("n_regionkey").cast("long").alias("warehouse_id"),
            F.col("o_custkey").cast("long").alias("customer_id"),
            status.alias("status"),
        )
    )


#: Room for line numbers in a line id; an order of 2^20 lines or more stops the load.
LINES_PER_ORDER = 1 << 20


def _lines(src: dict[str, DataFrame], parts: DataFrame | None = None) -> DataFrame:
    """One row per lineitem with a stable line id, and its ``parts`` (one row per product_id) if they are given.

    The window's partitions are single orders (a handful of rows), so it never concentrates data.
    Columns get their names first and are derived last: the lines are dealt with nothing twice, by
    the same order_id that they are joined by afterwards.
    """
    lines = src["lineitem"].select(
        F.col("l_orderkey").cast("long").alias("order_id"), F.col("l_partkey").cast("long").alias("product_id"),
        F.col("l_suppkey").cast("long").alias("supplier_id"), "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
        "l_extendedprice", F.expr("CAST(round(100 * l_discount) AS BIGINT)").alias("discount_pct"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax_pct"), "l_shipdate")
    if parts is not None:
        lines = lines.join(parts, "product_id", "left")
    w_line = Window.partitionBy("order_id").orderBy("l_linenumber", "product_id", "supplier_id", "l_extendedprice", "l_shipdate")
    number = F.col("number")
    return lines.withColumn("number", F.row_number().over(w_line)).select(
        (F.col("order_id") * LINES_PER_ORDER
         + F.when(number < LINES_PER_ORDER, number).otherwise(F.raise_error(F.lit("an order has too many lines for its ids")))).cast("long").alias("line_id"),
        "order_id", "product_id", "supplier_id", "quantity",
        F.expr("(CAST(round(100 * l_extendedprice) AS BIGINT) * (100 - discount_pct)) div (100 * quantity)").alias("price_cents"),
        F.to_date("l_shipdate").alias("ship_date"), "tax_pct", *([] if parts is None else ["parts"]))


def _unit_cost_cents():
    return F.round(F.col("p_retailprice") * COST_PER_LIST_DOLLAR_CENTS).cast("long")


def _part_facts(src: dict[str, DataFrame]) -> DataFrame:
    """A line's product attributes straight from the part table (same expressions as products)."""
    return src["part"].select(F.col("p_partkey").cast("long").alias("product_id"),
                              _unit_cost_cents().alias("unit_cost_cents"), F.col("p_type").alias("product_category"))


def _wide_lines(src: dict[str, DataFrame], orders: DataFrame) -> DataFrame:
    """Each line once with all that any of its tables needs: the order header and the product's cost and category.

    The product comes first, while the lines are narrow, as an array: of a repeated product every
    row gives the line once more, but under the same id. The numbering then deals the lines by order,
    so the join with the orders moves only those. Lines without an order keep empty headers
    (known_order is false).
    """
    header = orders.withColumn("known_order", F.lit(True))
    parts = _part_facts(src).groupBy("product_id").agg(F.collect_list(F.struct("unit_cost_cents", "product_category")).alias("parts"))
    lines = (_lines(src, parts).join(header, "order_id", "left").withColumn("known_order", F.coalesce("known_order", F.lit(False))))
    return lines.select("*", F.explode_outer("parts").alias("part")).select("*", "part.*").drop("parts", "part")


def _line_facts(lines: DataFrame) -> DataFrame:
    """The sales fact as a part of the loaded lines (those with a known order; the scan is left to filters that skip row groups)."""
    return lines.where(F.coalesce("known_order", F.lit(False))).withColumnRenamed("line_id", "order_line_id").select(*LINE_FACT_COLUMNS)


def _order_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("line_id").alias("order_line_id"), "order_id", "product_id", "quantity", "price_cents")


def _purchase_orders(lines: DataFrame, max_ship) -> DataFrame:
    expected = F.date_add("ship_date", _lead_time(F.col("supplier_id")))
    actual = F.date_add(expected, (F.col("tax_pct") * _reliability_m(F.col("supplier_id")) - 12).cast("int"))
    return lines.select(
        F.col("line_id").alias("po_id"), "supplier_id", "product_id",
        F.col("ship_date").alias("order_date"),
        expected.alias("expected_delivery_date"),
        F.when(actual <= max_ship, actual).alias("actual_delivery_date"),
        "quantity",
    )


def _pair_units(src: dict[str, DataFrame]) -> DataFrame:
    """Units per (part, supplier); product and supplier attributes roll up from it.

    Nearly every line is a pair of its own, so pairs are as many as lines. They are dealt by product
    alone: all that follows by product moves nothing more, and they are not written.
    """
    return (src["lineitem"].select(F.col("l_partkey").cast("long").alias("product_id"), F.col("l_suppkey").cast("long").alias("supplier_id"),
                                   F.col("l_quantity").cast("int").alias("quantity"))
            .repartition("product_id")
            .groupBy("product_id", "supplier_id").agg(F.sum("quantity").cast("long").alias("units")))


def _suppliers(src: dict[str, DataFrame], pair_units: DataFrame) -> DataFrame:
    supplier_category = (
        pair_units.join(src["part"].select(F.col("p_partkey").cast("long").alias("product_id"), "p_type"),
                        "product_id")
        .groupBy("supplier_id", "p_type").agg(F.sum("units").alias("units"))
        .groupBy("supplier_id").agg(
            # most units, ties to the smallest type name
            F.min(F.struct((-F.col("units")).alias("neg_units"), F.col("p_type")))
             .getField("p_type").alias("primary_category"))
    )
    return (
        src["supplier"].join(src["nation"].select("n_nationkey", "n_regionkey"),
                             F.col("s_nationkey") == F.col("n_nationkey"))
        .join(src["region"].select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").cast("long").alias("supplier_id"),
                F.col("s_name").alias("name"), F.col("r_name").alias("region"))
        .join(supplier_category, "supplier_id", "left")
        .select(
            "supplier_id", "name", "region", "primary_category",
            ((F.lit(95) - F.lit(15) * _reliability_m(F.col("supplier_id"))) / F.lit(100.0))
            .alias("base_reliability_score"),
            _lead_time(F.col("supplier_id")).alias("avg_lead_time_days"),
        )
    )


def _products(src: dict[str, DataFrame], pair_units: DataFrame, orders: DataFrame,
              warehouses: DataFrame) -> DataFrame:
    """Products with R1 stock thresholds from observed demand (all statuses)."""
    part_units = pair_units.groupBy("product_id").agg(
        F.sum("units").alias("units"),
        # most units, ties to the smallest supplier id
        F.min(F.struct((-F.col("units")).alias("neg_units"), F.col("supplier_id")))
         .getField("supplier_id").alias("supplier_id"),
    )
    bounds = orders.agg(F.max("order_date").alias("mx"), F.min("order_date").alias("mn"))
    period_days = bounds.select(F.greatest(F.datediff("mx", "mn"), F.lit(1))).scalar()
    n_warehouses = warehouses.agg(F.count(F.lit(1))).scalar()
    ltd = (F.coalesce(F.col("units"), F.lit(0)).cast("double") / period_days / n_warehouses
           * _lead_time(F.col("supplier_id")))
    safety = F.greatest(F.ceil(ltd * 0.5), F.lit(2)).cast("int")
    return (
        src["part"].select(F.col("p_partkey").cast("long").alias("product_id"), "p_type", "p_retailprice")
        .join(part_units, "product_id", "left")
        .select(
            "product_id",
            F.concat(F.upper(F.substring("p_type", 1, 3)), F.lit("-"),
                     F.expr("lpad(cast(product_id + 1 AS STRING), greatest(5, length(cast(product_id + 1 AS STRING))), '0')")).alias("sku"),
            F.col("p_type").alias("category"),
            _unit_cost_cents().alias("unit_cost_cents"),
            F.round(F.col("p_retailprice") * 100).cast("long").alias("unit_price_cents"),
            "supplier_id",
            safety.alias("safety_stock"),
            ltd.alias("ltd"),
            F.lit(None).cast("double").alias("popularity_score"),
        )
        .withColumn("reorder_point",
                    F.greatest(F.ceil(F.col("ltd") + F.col("safety_stock")), F.col("safety_stock") + 1).cast("int"))
        .select("product_id", "sku", "category", "unit_cost_cents", "unit_price_cents", "supplier_id",
                "reorder_point", "safety_stock", "popularity_score")
    )


def _inventory(products: DataFrame, warehouses: DataFrame, orders: DataFrame) -> DataFrame:
    """Every (warehouse, product) position: the warehouse ids, one array, explode on each product row."""
    wh_ids = warehouses.agg(F.collect_list("warehouse_id")).scalar()
    max_order_date = orders.agg(F.max("order_date")).scalar()
    wid, pid = F.col("warehouse_id"), F.col("product_id")
    bucket = (pid * 37 + wid * 53 + (pid % 7) * 11) % 100
    on_hand = (
        F.when(F.col("bkt") < 12, F.expr("(reorder_point * (10 + 7 * bkt)) div 100"))
        .when(F.col("bkt") < 22, F.expr("safety_stock * (4 + bkt % 5)"))
        .otherwise(F.expr("reorder_point + 1 + (safety_stock * (bkt % 10)) div 20"))
    )
    return (
        products.select("product_id", "reorder_point", "safety_stock")
        .withColumn("warehouse_id", F.explode(wh_ids))
        .withColumn("bkt", bucket)
        .select(
            "warehouse_id", "product_id",
            on_hand.cast("int").alias("quantity_on_hand"),
            F.date_sub(max_order_date,
                       (F.lit(1) + (pid * 13 + wid * 29) % 119).cast("int")).alias("last_restock_date"),
        )
    )


# Stage plan: each phase only needs earlier phases, stages inside a phase are
# independent (the loader runs them concurrently). The lines are written once;
# order lines, purchase orders and the sales fact are projections of them.
PHASES = (
    (("warehouses", lambda src, t: _warehouses(src)),
     ("orders", lambda src, t: _orders(src))),
    (("lines", lambda src, t: _wide_lines(src, t["orders"])),
     ("suppliers", lambda src, t: _suppliers(src, _pair_units(src))),
     ("products", lambda src, t: _products(src, _pair_units(src), t["orders"], t["warehouses"]))),
    (("inventory", lambda src, t: _inventory(t["products"], t["warehouses"], t["orders"])),),
)


def model_from_stages(t: dict[str, DataFrame], max_ship=None) -> Model:
    """``max_ship`` is the last shipping date where the loader knows it, else it is a scalar subquery."""
    last = t["lines"].agg(F.max("ship_date")).scalar() if max_ship is None else F.lit(max_ship)
    return Model(warehouses=t["warehouses"], suppliers=t["suppliers"], products=t["products"],
                 inventory=t["inventory"], purchase_orders=_purchase_orders(t["lines"], last),
                 orders=t["orders"], order_lines=_order_lines(t["lines"]),
                 line_facts=_line_facts(t["lines"]) if "known_order" in t["lines"].columns else None)


def bind_frames(src: dict[str, DataFrame]) -> Model:
    """Derive the seven tables as one lazy plan; lines and orders meet only where a query needs both."""
    t: dict[str, DataFrame] = {}
    for phase in PHASES:
        for name, build in phase:
            t[name] = _lines(src) if name == "lines" else build(src, t)
    return model_from_stages(t)
