"""Oracle SQL for the enriched views (J1, J2) and the six questions.

Facts are reduced to the grain of the answer first, dimensions are looked up
afterwards, and limits are ranks over the reduced rows.
"""

from skuflow.oracle.binding import with_binding
from skuflow.oracle.sqltext import dollars, i64, pct, rr

SQL: dict[str, str] = {}

_SHORT = f"""
short_stock AS (
    SELECT warehouse_id, product_id, sku, category, quantity_on_hand, reorder_point, safety_stock,
           {pct('quantity_on_hand', 'reorder_point', 1)} AS pct_of_reorder_point
    FROM b_products JOIN b_inventory USING (product_id)
    WHERE reorder_point > quantity_on_hand
)"""

SQL["sales_detail"] = with_binding(f"""
SELECT order_line_id, order_id, product_id, quantity, {dollars('price_cents')} AS unit_price_at_sale,
       {dollars('revenue_c')} AS line_revenue, {dollars('revenue_c - cogs_c')} AS line_margin,
       {dollars('cogs_c')} AS line_cogs, order_date, warehouse_id, customer_id, status, sku, category,
       {dollars('unit_cost_cents')} AS unit_cost, supplier_id,
       name AS warehouse_name, region AS warehouse_region
FROM delivered JOIN costed USING (order_id) JOIN b_warehouses USING (warehouse_id)
""", """
delivered AS (
    SELECT order_id, order_date, warehouse_id, customer_id, status FROM b_orders WHERE status = 'Delivered'
),
costed AS (
    SELECT order_line_id, order_id, product_id, quantity, price_cents, sku, category, unit_cost_cents, supplier_id,
           quantity * price_cents AS revenue_c, quantity * unit_cost_cents AS cogs_c
    FROM b_products JOIN b_order_lines USING (product_id)
)""")

SQL["inventory_detail"] = with_binding(f"""
SELECT warehouse_id, product_id, quantity_on_hand, last_restock_date,
       {dollars('unit_cost_cents * quantity_on_hand')} AS inventory_value, sku, category,
       {dollars('unit_cost_cents')} AS unit_cost, {dollars('unit_price_cents')} AS unit_price,
       reorder_point, safety_stock, supplier_id, warehouse_name, warehouse_region
FROM b_products JOIN placed USING (product_id)
""", """
placed AS (
    SELECT product_id, warehouse_id, quantity_on_hand, last_restock_date,
           name AS warehouse_name, region AS warehouse_region
    FROM b_warehouses JOIN b_inventory USING (warehouse_id)
)""")

SQL["warehouse_performance"] = with_binding(f"""
SELECT warehouse_id, name AS warehouse_name, region, n AS total_orders,
       {dollars('cents')} AS total_revenue, {rr('cents', 'n * 100')} AS avg_order_value,
       {pct('returned', 'n')} AS return_rate_pct, {pct('cancelled', 'n')} AS cancellation_rate_pct
FROM b_warehouses JOIN per_warehouse USING (warehouse_id)
""", """
per_order AS (
    SELECT order_id, sum(quantity * price_cents) AS order_cents FROM b_order_lines GROUP BY order_id
),
per_warehouse AS (
    SELECT warehouse_id, count(*) AS n, sum(order_cents) AS cents,
           count(*) FILTER (WHERE status = 'Returned') AS returned,
           count(*) FILTER (WHERE status = 'Cancelled') AS cancelled
    FROM per_order JOIN b_orders USING (order_id)
    GROUP BY warehouse_id
)""")

SQL["top_revenue_products"] = with_binding(f"""
SELECT product_id, sku, category, n_orders AS orders_containing_product, {i64('units')} AS units_sold,
       {dollars('cents')} AS total_revenue, {dollars('cents - units * unit_cost_cents')} AS total_margin
FROM best JOIN b_products USING (product_id)
""", """
per_basket AS (
    SELECT product_id, order_id, sum(quantity) AS basket_units, sum(quantity * price_cents) AS basket_cents
    FROM b_order_lines GROUP BY product_id, order_id
),
best AS (
    SELECT product_id, count(*) AS n_orders, sum(basket_units) AS units, sum(basket_cents) AS cents
    FROM per_basket GROUP BY product_id
    QUALIFY row_number() OVER (ORDER BY sum(basket_cents) DESC, product_id) <= 20
)""")

SQL["stockout_risk"] = with_binding("""
SELECT product_id, sku, category, name AS warehouse_name, quantity_on_hand, reorder_point, safety_stock,
       pct_of_reorder_point
FROM short_stock JOIN b_warehouses USING (warehouse_id)
QUALIFY row_number() OVER (ORDER BY pct_of_reorder_point NULLS FIRST, product_id, warehouse_id) <= 50
""", _SHORT)

SQL["supplier_reliability"] = with_binding(f"""
SELECT supplier_id, name AS supplier_name, region, primary_category, n AS total_purchase_orders,
       arrived AS delivered_pos, {pct('late', 'arrived')} AS late_delivery_rate_pct,
       {rr('days_off', 'arrived')} AS avg_delay_days
FROM punctuality JOIN b_suppliers USING (supplier_id)
QUALIFY row_number() OVER (ORDER BY late_delivery_rate_pct DESC NULLS LAST, supplier_id) <= 20
""", """
delays AS (
    SELECT supplier_id, date_diff('day', expected_delivery_date, actual_delivery_date) AS days
    FROM b_purchase_orders
),
punctuality AS (
    SELECT supplier_id, count(*) AS n, count(days) AS arrived, count(*) FILTER (WHERE days > 0) AS late,
           sum(days) AS days_off
    FROM delays GROUP BY supplier_id HAVING count(days) >= 5
)""")

SQL["dead_stock_value"] = with_binding(f"""
SELECT category, sum(positions) :: BIGINT AS dead_stock_positions, {i64('sum(units)')} AS total_units_tied_up,
       {dollars('sum(units * unit_cost_cents)')} AS dead_stock_value
FROM surplus JOIN b_products USING (product_id)
GROUP BY category
""", """
surplus AS (
    SELECT product_id, count(*) AS positions, sum(quantity_on_hand) AS units
    FROM b_inventory JOIN (SELECT product_id, 4 * safety_stock AS ceiling FROM b_products) USING (product_id)
    WHERE ceiling <= quantity_on_hand
    GROUP BY product_id
)""")

SQL["reorder_recommendations"] = with_binding(f"""
SELECT product_id, sku, category, name AS warehouse_name, quantity_on_hand, reorder_point, safety_stock,
       {i64('sold')} AS units_sold_last_30_days, {rr('sold', '30')} AS avg_daily_demand,
       {i64('need')} AS recommended_order_quantity
FROM needs JOIN b_warehouses USING (warehouse_id)
QUALIFY row_number() OVER (ORDER BY need DESC, product_id, warehouse_id) <= 50
""", _SHORT + """,
demand AS (
    SELECT warehouse_id, product_id, sum(quantity) AS sold_units
    FROM (SELECT order_id, warehouse_id FROM b_orders, b_bounds WHERE date_diff('day', order_date, max_date) <= 30)
    JOIN b_order_lines USING (order_id)
    GROUP BY warehouse_id, product_id
),
needs AS (
    SELECT *, greatest(safety_stock + sold - quantity_on_hand, 0) AS need
    FROM (SELECT short_stock.*, coalesce(sold_units, 0) AS sold
          FROM short_stock LEFT JOIN demand USING (warehouse_id, product_id))
)""")
