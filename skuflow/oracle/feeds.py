"""Oracle SQL for the BI feeds."""

from skuflow.oracle.analysis import _ABC, _DELIVERED_FACTS
from skuflow.oracle.analysis import SQL as A
from skuflow.oracle.binding import with_binding
from skuflow.oracle.measures import view_sql

SQL: dict[str, str] = {}

SQL["feed_exec_kpis"] = view_sql(("lines", "inventory", "supplier_dim"),
                                 ["total_revenue", "margin_pct", "inventory_value", "stockout_risk_pct",
                                  "high_risk_suppliers"], [])
SQL["feed_revenue_by_category"] = view_sql(("lines",), ["total_revenue"], ["category"])
SQL["feed_inventory_by_class"] = view_sql(("inventory",), ["inventory_value", "dead_stock_value", "units_on_hand"],
                                          ["abc_class"])
SQL["feed_turnover_vs_value"] = view_sql(("lines+inventory",), ["inventory_turnover", "inventory_value"],
                                         ["category"])
SQL["feed_late_rate_monthly"] = view_sql(("purchase_orders",), ["late_delivery_rate", "delivered_pos", "late_pos"],
                                         ["year_month"])

SQL["feed_warehouse_matrix"] = with_binding("""
SELECT w.name AS warehouse_name, p.category, CAST(sum(f.rc) AS DOUBLE) / 100 AS revenue,
       GROUPING(w.name, p.category) AS grouping_level
FROM q_f f JOIN b_products p ON p.product_id = f.product_id JOIN b_warehouses w ON w.warehouse_id = f.warehouse_id
GROUP BY CUBE (w.name, p.category)
ORDER BY grouping_level, warehouse_name, category
""", _DELIVERED_FACTS)

SQL["feed_below_reorder"] = with_binding("""
SELECT p.product_id, p.sku, p.category, i.warehouse_id, w.name AS warehouse_name, i.quantity_on_hand,
       p.reorder_point
FROM b_inventory i JOIN b_products p ON p.product_id = i.product_id
JOIN b_warehouses w ON w.warehouse_id = i.warehouse_id
WHERE i.quantity_on_hand < p.reorder_point
ORDER BY i.quantity_on_hand, p.product_id, i.warehouse_id
""")

SQL["pareto_curve"] = with_binding("""
SELECT rnk AS rank, round_even(CAST(rnk * 100 AS DOUBLE) / CAST(n AS DOUBLE), 2) AS sku_pct,
       round_even(CAST(100 AS DOUBLE) * (CAST(cum AS DOUBLE) / CAST(tot AS DOUBLE)), 2) AS cum_revenue_pct
FROM (SELECT *, count(*) OVER () AS n FROM q_cls)
WHERE (rnk - 1) % greatest(1, n // 60) = 0
ORDER BY rnk
""", _ABC)

SQL["pareto_crossing"] = with_binding(" UNION ALL ".join(f"""
SELECT {t} AS threshold_pct, rank, round_even(CAST(rank * 100 AS DOUBLE) / CAST(n AS DOUBLE), 2) AS sku_pct
FROM (SELECT min(CASE WHEN cum * 100 >= tot * {t} THEN rnk END) AS rank, count(*) AS n FROM q_cls)"""
                                                      for t in (80, 95)), _ABC)

SQL["stock_health_mix"] = f"""
SELECT * FROM (
    SELECT *, CASE stock_status WHEN 'Healthy' THEN 0 WHEN 'Overstocked' THEN 1 WHEN 'Slow-Moving' THEN 2
                                WHEN 'Dead' THEN 3 END AS display_order
    FROM ({A['dead_stock_summary']}))
WHERE display_order IS NOT NULL ORDER BY display_order
"""

SQL["dashboard_top_products"] = f"""
SELECT rank, sku, category, units_sold, total_revenue FROM ({A['abc_classification']}) WHERE rank <= 10
ORDER BY rank
"""

SQL["dashboard_bottom_suppliers"] = f"""
SELECT supplier_id, supplier_name, composite_score, risk_tier, late_delivery_rate_pct
FROM ({A['supplier_scorecard']}) ORDER BY composite_score, supplier_id LIMIT 15
"""
