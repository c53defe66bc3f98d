"""Oracle SQL for R1-R4."""

from skuflow.oracle.binding import with_binding

SQL: dict[str, str] = {}

_UNITS = """
q_units AS (
    SELECT p.product_id, p.sku, p.category, p.supplier_id, p.safety_stock, p.reorder_point,
           CAST(coalesce(s.u, 0) AS BIGINT) AS units_sold
    FROM b_products p
    LEFT JOIN (SELECT product_id, sum(quantity) AS u FROM b_order_lines GROUP BY product_id) s
           ON s.product_id = p.product_id
)"""

SQL["stock_thresholds"] = with_binding("""
SELECT product_id, sku, category, supplier_id, units_sold, daily_demand_per_warehouse, lead_time_days,
       lead_time_demand, safety_stock, reorder_point, recommended_safety_stock,
       CAST(greatest(ceil(lead_time_demand + recommended_safety_stock), recommended_safety_stock + 1) AS INTEGER)
           AS recommended_reorder_point
FROM (
    SELECT *, CAST(greatest(ceil(lead_time_demand * 0.5), 2) AS INTEGER) AS recommended_safety_stock
    FROM (
        SELECT u.product_id, u.sku, u.category, u.supplier_id, u.units_sold,
               CAST(u.units_sold AS DOUBLE) / (SELECT greatest(date_diff('day', min(order_date), max(order_date)), 1)
                                               FROM b_orders) / (SELECT count(*) FROM b_warehouses)
                   AS daily_demand_per_warehouse,
               s.avg_lead_time_days AS lead_time_days,
               CAST(u.units_sold AS DOUBLE) / (SELECT greatest(date_diff('day', min(order_date), max(order_date)), 1)
                                               FROM b_orders) / (SELECT count(*) FROM b_warehouses)
                   * s.avg_lead_time_days AS lead_time_demand,
               u.safety_stock, u.reorder_point
        FROM q_units u LEFT JOIN b_suppliers s ON s.supplier_id = u.supplier_id))
""", _UNITS)

SQL["demand_percentile"] = with_binding("""
SELECT product_id, sku, category, units_sold,
       CAST(2 * (rank() OVER (ORDER BY units_sold) - 1) + count(*) OVER (PARTITION BY units_sold) + 1 AS DOUBLE)
           / CAST(2 * count(*) OVER () AS DOUBLE) AS demand_percentile
FROM q_units
""", _UNITS)

SQL["seasonal_index"] = with_binding("""
SELECT month, order_count,
       CAST(order_count * count(*) OVER () AS DOUBLE) / CAST(sum(order_count) OVER () AS DOUBLE) AS seasonal_index
FROM (SELECT CAST(month(order_date) AS INTEGER) AS month, count(*) AS order_count FROM b_orders GROUP BY 1)
ORDER BY month
""")

SQL["order_mix_profile"] = with_binding("""
SELECT 'status_share:' || status AS metric,
       CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM b_orders) AS DOUBLE) AS value
FROM b_orders GROUP BY status
UNION ALL
SELECT 'lines_per_order', CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT ol.order_id) AS DOUBLE)
FROM b_order_lines ol JOIN b_products p ON p.product_id = ol.product_id
UNION ALL
SELECT 'units_per_line', CAST(sum(ol.quantity) AS DOUBLE) / CAST(count(*) AS DOUBLE)
FROM b_order_lines ol JOIN b_products p ON p.product_id = ol.product_id
UNION ALL
SELECT 'share_lines_below_list_price', CAST(count_if(ol.price_cents < p.unit_price_cents) AS DOUBLE)
           / CAST(count(*) AS DOUBLE)
FROM b_order_lines ol JOIN b_products p ON p.product_id = ol.product_id
""")

SQL["row_counts"] = with_binding(" UNION ALL ".join(
    f"SELECT {i} AS load_order, '{t}' AS table_name, count(*) AS row_count FROM b_{t}"
    for i, t in enumerate(("warehouses", "suppliers", "products", "inventory", "purchase_orders", "orders",
                           "order_lines"))))

SQL["line_revenue_quantiles"] = with_binding("""
SELECT share, max(CASE WHEN k = floor(share * (n - 1)) THEN c END) AS lower_cents, max(CASE WHEN k = ceil(share * (n - 1)) THEN c END) AS upper_cents,
       quantile_cont_value / 100 AS revenue
FROM (SELECT CAST(s AS DOUBLE) AS share, n, k, c,
             CASE CAST(s AS DOUBLE) WHEN 0.25 THEN q[1] WHEN 0.5 THEN q[2] WHEN 0.75 THEN q[3] WHEN 0.9 THEN q[4] ELSE q[5] END AS quantile_cont_value
      FROM (SELECT CAST(quantity * price_cents AS BIGINT) AS c, row_number() OVER (ORDER BY quantity * price_cents) - 1 AS k, count(*) OVER () AS n
            FROM b_order_lines),
           (SELECT quantile_cont(CAST(quantity * price_cents AS DOUBLE), [0.25, 0.5, 0.75, 0.9, 0.99]) AS q FROM b_order_lines),
           (SELECT unnest([0.25, 0.5, 0.75, 0.9, 0.99]) AS s))
GROUP BY share, quantile_cont_value""")
