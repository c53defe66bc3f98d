"""The seven-table operational model as a bundle of lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.sources.schemas import DOLLAR_COLUMNS, LOAD_ORDER, MODEL_SCHEMAS, dollar_schema


LINE_FACT_COLUMNS = ("order_line_id", "order_id", "product_id", "quantity", "price_cents", "order_date",
                     "warehouse_id", "customer_id", "status", "unit_cost_cents", "product_category")


def join_line_facts(order_lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their order header and the product's unit cost and category (the sales fact grain).

    ``products`` is (product_id, unit_cost_cents, product_category); it is a left join so a
    line never disappears because of its product.
    """
    return (order_lines.join(orders, "order_id").join(products, "product_id", "left")
            .select(*LINE_FACT_COLUMNS))


def _delivered_dates(m: "Model") -> DataFrame:
    return m.facts.filter(F.col("status") == "Delivered").select("order_date")


def _any_dates(m: "Model") -> DataFrame:
    return m.orders.select("order_date").unionByName(m.purchase_orders.select("order_date"))


# name -> scalar subquery builder (used when no recorded value exists)
SCALARS = {
    "max_order_date": lambda m: m.orders.agg(F.max("order_date")).scalar(),
    "min_order_date": lambda m: m.orders.agg(F.min("order_date")).scalar(),
    "max_delivered_date": lambda m: _delivered_dates(m).agg(F.max("order_date")).scalar(),
    "min_delivered_date": lambda m: _delivered_dates(m).agg(F.min("order_date")).scalar(),
    "max_any_date": lambda m: _any_dates(m).agg(F.max("order_date")).scalar(),
    "min_any_date": lambda m: _any_dates(m).agg(F.min("order_date")).scalar(),
    "warehouse_count": lambda m: m.warehouses.agg(F.count(F.lit(1))).scalar(),
}


def record_stats(m: "Model") -> dict:
    """Compute every entry of SCALARS, and the number of lines, with one small job per table."""
    o = m.orders.agg(F.max("order_date").alias("mx"), F.min("order_date").alias("mn")).first()
    d = _delivered_dates(m).agg(F.max("order_date").alias("mx"), F.min("order_date").alias("mn")).first()
    p = m.purchase_orders.agg(F.max("order_date").alias("mx"), F.min("order_date").alias("mn")).first()
    w = m.warehouses.count()
    dates = [x for x in (o["mx"], p["mx"]) if x is not None]
    lows = [x for x in (o["mn"], p["mn"]) if x is not None]
    return {"max_order_date": o["mx"], "min_order_date": o["mn"], "max_delivered_date": d["mx"],
            "min_delivered_date": d["mn"], "max_any_date": max(dates) if dates else None,
            "min_any_date": min(lows) if lows else None, "warehouse_count": w,
            "line_count": m.order_lines.count()}


@dataclass(frozen=True)
class Model:
    """Operational tables.  Nothing here is materialised unless asked."""

    warehouses: DataFrame
    suppliers: DataFrame
    products: DataFrame
    inventory: DataFrame
    purchase_orders: DataFrame
    orders: DataFrame
    order_lines: DataFrame
    # Lines with their order header (date, warehouse, customer, status).  The
    # loader stages this join once; lazily it is the join itself.
    line_facts: DataFrame | None = None
    # Scalar facts recorded by the loader (dates as ``datetime.date``); operators
    # use them as literals so date filters reach the Parquet scan.
    stats: dict | None = None
    # Results that several operators of this model share (the revenue ranking), by name.
    memo: dict = field(default_factory=dict, compare=False, repr=False)

    def scalar(self, name: str):
        """A model-wide scalar as a Column: a literal when the loader recorded it,
        otherwise a scalar subquery (evaluated on the executors)."""
        if self.stats and name in self.stats:
            return F.lit(self.stats[name])
        return SCALARS[name](self)

    @property
    def spark(self) -> SparkSession:
        return self.orders.sparkSession

    @property
    def facts(self) -> DataFrame:
        """order_lines joined to orders (inner) with unit cost and category: the sales fact at line grain."""
        if self.line_facts is not None:
            return self.line_facts
        return join_line_facts(self.order_lines, self.orders,
                               self.products.select("product_id", "unit_cost_cents", F.col("category").alias("product_category")))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in LOAD_ORDER}

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replace(self, **frames: DataFrame) -> "Model":
        t = self.tables()
        t.update(frames)
        if not {"order_lines", "orders", "products", "line_facts"} & set(frames):
            t["line_facts"] = self.line_facts
        return Model(**t)   # recorded stats may no longer hold for replaced tables

    def register_views(self, prefix: str = "") -> None:
        """S3: expose the model to ``spark.sql`` as temp views."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(f"{prefix}{name}")

    # --- S4/S5: load into the declared schema, idempotent full rebuild -----------
    def write_parquet(self, path: str) -> None:
        """Materialise the model once (full, idempotent overwrite).

        Facts are clustered by month of their event date so later date
        filters prune files; dimensions are written as is.
        """
        for name in LOAD_ORDER:
            df = self.table(name).select(*MODEL_SCHEMAS[name].fieldNames())
            w = df.write.mode("overwrite")
            if name in ("orders", "purchase_orders"):
                w = df.withColumn("order_month", F.date_format("order_date", "yyyy-MM")) \
                      .write.mode("overwrite").partitionBy("order_month")
            w.parquet(f"{path}/{name}")

    @staticmethod
    def read_parquet(spark: SparkSession, path: str) -> "Model":
        frames = {}
        for name in LOAD_ORDER:
            df = spark.read.parquet(f"{path}/{name}")
            frames[name] = df.select(
                *[F.col(f.name).cast(f.dataType) for f in MODEL_SCHEMAS[name].fields])
        return Model(**frames)

    @staticmethod
    def read_csv(spark: SparkSession, path: str, dollars: bool = False) -> "Model":
        """One headered CSV per table, read with the declared schema.

        With ``dollars`` the money columns are decimal dollars under their plain
        names (``DOLLAR_COLUMNS``), headers are compared, and cents are derived.
        ``FAILFAST`` turns a malformed row into an error instead of a NULL,
        the closest Spark gets to the reference's typed-insert rejection.
        """
        frames = {}
        for name in LOAD_ORDER:
            schema = MODEL_SCHEMAS[name]
            read = spark.read.schema(dollar_schema(schema) if dollars else schema)
            frame = (read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", not dollars)
                     .option("dateFormat", "yyyy-MM-dd").csv(f"{path}/{name}.csv"))
            frames[name] = frame.select(*[
                (F.col(DOLLAR_COLUMNS[f.name]) * 100).cast("long").alias(f.name)
                if dollars and f.name in DOLLAR_COLUMNS else F.col(f.name) for f in schema.fields])
        return Model(**frames)

    def write_csv(self, path: str) -> None:
        for name in LOAD_ORDER:
            self.table(name).write.mode("overwrite").option("header", True).csv(f"{path}/{name}.csv")
