"""Declared schemas of the seven operational tables (no inference anywhere).

Money columns hold integer cents (``*_cents``); the reference stores REAL
dollars, which are produced only at the output edge.
"""

from pyspark.sql import types as T

_L, _I, _S, _D, _DT = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


WAREHOUSES = _schema(("warehouse_id", _L, False), ("name", _S, False), ("region", _S, False),
                     ("capacity_units", _I, False))
SUPPLIERS = _schema(("supplier_id", _L, False), ("name", _S, False), ("region", _S, False),
                    ("primary_category", _S, True), ("base_reliability_score", _D, False),
                    ("avg_lead_time_days", _I, False))
PRODUCTS = _schema(("product_id", _L, False), ("sku", _S, False), ("category", _S, False),
                   ("unit_cost_cents", _L, False), ("unit_price_cents", _L, False),
                   ("supplier_id", _L, True), ("reorder_point", _I, False),
                   ("safety_stock", _I, False), ("popularity_score", _D, True))
INVENTORY = _schema(("warehouse_id", _L, False), ("product_id", _L, False),
                    ("quantity_on_hand", _I, False), ("last_restock_date", _DT, False))
PURCHASE_ORDERS = _schema(("po_id", _L, False), ("supplier_id", _L, False), ("product_id", _L, False),
                          ("order_date", _DT, False), ("expected_delivery_date", _DT, False),
                          ("actual_delivery_date", _DT, True), ("quantity", _I, False))
ORDERS = _schema(("order_id", _L, False), ("order_date", _DT, False), ("warehouse_id", _L, False),
                 ("customer_id", _L, False), ("status", _S, False))
ORDER_LINES = _schema(("order_line_id", _L, False), ("order_id", _L, False), ("product_id", _L, False),
                      ("quantity", _I, False), ("price_cents", _L, False))

MODEL_SCHEMAS = {
    "warehouses": WAREHOUSES,
    "suppliers": SUPPLIERS,
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "purchase_orders": PURCHASE_ORDERS,
    "orders": ORDERS,
    "order_lines": ORDER_LINES,
}

# Names of the money columns where files hold dollars.
DOLLAR_COLUMNS = {"unit_cost_cents": "unit_cost", "unit_price_cents": "unit_price", "price_cents": "unit_price_at_sale"}


def dollar_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with its money columns as decimal dollars."""
    return T.StructType([T.StructField(DOLLAR_COLUMNS[f.name], T.DecimalType(18, 2), f.nullable)
                         if f.name in DOLLAR_COLUMNS else f for f in schema.fields])


# Parents before children (the reference's load order).
LOAD_ORDER = ("warehouses", "suppliers", "products", "inventory", "purchase_orders",
              "orders", "order_lines")

# Fixed values of the model: order status domain and the simulator-only columns
# that no analysis may read.
ORDER_STATUSES = ("Delivered", "Cancelled", "Returned")
HIDDEN_COLUMNS = {"products": "popularity_score", "suppliers": "base_reliability_score"}
