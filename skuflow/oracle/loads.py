"""Oracle SQL of the faulty load and of the published star: counted from the rules, without any file."""

from skuflow.oracle.binding import with_binding
from skuflow.oracle.star import STAR_CTES

SQL: dict[str, str] = {}

_ORDER_GONE = "o.order_id % 50 IN (7, 11, 13)"


def _row(table: str, outcome: str, source: str, condition: str = "true") -> str:
    return f"SELECT '{table}' AS \"table\", '{outcome}' AS outcome, count(*) AS rows FROM {source} WHERE {condition}"


_LINES = "b_order_lines l JOIN b_orders o ON o.order_id = l.order_id"
_REJECTED = [
    _row("purchase_orders", "supplier_id is missing", "b_purchase_orders", "po_id % 60 = 1"),
    _row("purchase_orders", "expected_delivery_date is no date", "b_purchase_orders", "po_id % 60 = 2"),
    _row("orders", "malformed row", "b_orders", "order_id % 50 = 7"),
    _row("orders", "repeats order_id", "b_orders", "order_id % 50 = 9"),
    _row("orders", "order_date is no date", "b_orders", "order_id % 50 = 11"),
    _row("orders", "status is not in its domain", "b_orders", "order_id % 50 = 13"),
    _row("order_lines", "breaks quantity > 0", "b_order_lines", "order_line_id % 40 = 3"),
    _row("order_lines", "quantity is no int", "b_order_lines", "order_line_id % 40 = 5"),
    _row("order_lines", "product_id is not in products", "b_order_lines", "order_line_id % 40 = 7"),
    _row("order_lines", "unit_price_at_sale is no amount in cents", "b_order_lines", "order_line_id % 40 = 9"),
    _row("order_lines", "order_id is not in orders", _LINES, _ORDER_GONE),
]
_LOADED = [
    *(_row(t, "loaded", f"b_{t}") for t in ("warehouses", "suppliers", "products", "inventory")),
    _row("purchase_orders", "loaded", "b_purchase_orders", "po_id % 60 NOT IN (1, 2)"),
    _row("orders", "loaded", "b_orders o", f"NOT ({_ORDER_GONE})"),
    _row("order_lines", "loaded", _LINES, f"l.order_line_id % 40 NOT IN (3, 5, 7, 9) AND NOT ({_ORDER_GONE})"),
]
SQL["load_rejects"] = with_binding(
    f"SELECT * FROM ({' UNION ALL '.join(_REJECTED)}) WHERE rows > 0\nUNION ALL\n{' UNION ALL '.join(_LOADED)}")

_TABLES = {"dim_date": "q_dim_date", "dim_product": "q_dim_product", "dim_supplier": "q_dim_supplier",
           "dim_warehouse": "(SELECT warehouse_id, name, region, capacity_units FROM b_warehouses)", "fact_sales": "q_fact_sales",
           "fact_inventory": "q_fact_inventory", "fact_purchase_orders": "q_fact_po"}
# The columns of the published star, in order.
_COLUMNS = {
    "dim_date": "date,date_key,year,quarter,month,month_name,year_month,day_of_week,day_name,is_weekend,fiscal_year,month_sort",
    "dim_product": "product_id,sku,category,unit_cost,unit_price,supplier_id,reorder_point,safety_stock,abc_class,margin_pct",
    "dim_supplier": "supplier_id,name,region,primary_category,avg_lead_time_days,composite_score,risk_tier,late_delivery_rate_pct,avg_delay_days",
    "dim_warehouse": "warehouse_id,name,region,capacity_units",
    "fact_sales": "order_line_id,order_id,product_id,warehouse_id,customer_id,status,quantity,unit_price_at_sale,line_revenue,line_margin,line_cogs,date_key",
    "fact_inventory": "warehouse_id,product_id,quantity_on_hand,last_restock_date,reorder_point,safety_stock,inventory_value,is_below_reorder_point,"
                      "units_above_safety_stock",
    "fact_purchase_orders": "po_id,supplier_id,product_id,expected_delivery_date,actual_delivery_date,quantity,delay_days,is_delivered,is_late,date_key",
}
_AUDIT = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({len(cols.split(','))} AS INTEGER) AS column_count, '{cols}' AS column_names FROM {_TABLES[name]}"
    for name, cols in _COLUMNS.items())
SQL["star_publication"] = with_binding(_AUDIT, STAR_CTES)
SQL["star_publication_csv"] = SQL["star_publication"]
