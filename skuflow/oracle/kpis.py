"""Oracle SQL for C11-C15."""

from skuflow.oracle.analysis import _ABC, _DELIVERED_FACTS, _SCORE, _dead
from skuflow.oracle.analysis import SQL as A
from skuflow.oracle.binding import with_binding
from skuflow.oracle.questions import SQL as Q

from skuflow.oracle.measures import _FAMILIES

SQL: dict[str, str] = {}


def _mil(x: str) -> str:
    return f"round_even(CAST({x} AS DOUBLE) / 100 / CAST(1000000 AS DOUBLE), 1)"


def _pct1(n: str, d: str) -> str:
    return f"round_even(CAST(100 AS DOUBLE) * CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0), 1)"


SQL["headline_kpis"] = with_binding(f"""
SELECT {_mil('rev')} AS revenue_m, {_mil('margin')} AS margin_m, {_pct1('margin', 'rev')} AS margin_pct,
       {_mil('inv')} AS inventory_value_m, {_mil('coalesce(dead, 0)')} AS dead_stock_m,
       {_pct1('coalesce(dead, 0)', 'inv')} AS dead_stock_pct, {_mil('coalesce(problem, 0)')} AS dead_plus_slow_m,
       below AS stockout_count, positions AS stockout_total, {_pct1('below', 'positions')} AS stockout_pct,
       hr AS high_risk_suppliers, n_sc AS total_suppliers
FROM (SELECT sum(f.rc) AS rev, sum(f.rc - CAST(f.quantity AS BIGINT) * p.unit_cost_cents) AS margin
      FROM q_f f JOIN b_products p ON p.product_id = f.product_id),
     (SELECT sum(vc) AS inv, sum(CASE WHEN stock_status = 'Dead' THEN vc END) AS dead,
             sum(CASE WHEN stock_status IN ('Dead', 'Slow-Moving') THEN vc END) AS problem FROM q_dead),
     (SELECT count_if(i.quantity_on_hand < p.reorder_point) AS below, count(*) AS positions
      FROM b_inventory i JOIN b_products p ON p.product_id = i.product_id),
     (SELECT count_if(risk_tier = 'High Risk') AS hr, count(*) AS n_sc FROM q_card)
""", _dead(90) + "," + _SCORE)

_MONTHLY = _DELIVERED_FACTS + """,
q_monthly AS (
    SELECT strftime(f.order_date, '%Y-%m') AS year_month, w.name AS warehouse_name, sum(f.rc) AS rc
    FROM q_f f JOIN b_warehouses w ON w.warehouse_id = f.warehouse_id
    GROUP BY 1, 2
)"""

SQL["monthly_revenue"] = with_binding(
    "SELECT year_month, warehouse_name, CAST(rc AS DOUBLE) / 100 AS revenue FROM q_monthly "
    "ORDER BY year_month, warehouse_name", _MONTHLY)

# The five warehouses of the TPC-H binding (one per region).
_WAREHOUSE_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SQL["monthly_revenue_pivot"] = with_binding(
    "SELECT year_month, " + ", ".join(
        f"coalesce(round_even(CAST(sum(CASE WHEN warehouse_name = '{n}' THEN rc END) AS DOUBLE) / 100, 0), 0)"
        f" AS \"{n}\"" for n in _WAREHOUSE_NAMES) + " FROM q_monthly GROUP BY year_month ORDER BY year_month",
    _MONTHLY)

SQL["warehouse_scale_quality"] = with_binding("""
SELECT r.warehouse_id, w.name AS warehouse_name,
       round_even(CAST(r.rc AS DOUBLE) / 100, 2) AS total_revenue, r.delivered_orders, q.total_orders,
       round_even(CAST(100 AS DOUBLE) * (CAST(q.ret AS DOUBLE) / CAST(q.n AS DOUBLE)), 2) AS return_rate_pct,
       round_even(CAST(100 AS DOUBLE) * (CAST(q.can AS DOUBLE) / CAST(q.n AS DOUBLE)), 2) AS cancel_rate_pct,
       round_even((CAST(r.rc AS DOUBLE) / 100) / CAST(r.delivered_orders AS DOUBLE), 2) AS avg_order_value
FROM (SELECT warehouse_id, sum(rc) AS rc, count(DISTINCT order_id) AS delivered_orders FROM q_f
      GROUP BY warehouse_id) r
LEFT JOIN (SELECT warehouse_id, count(DISTINCT order_id) AS total_orders,
                  count_if(status = 'Returned') AS ret, count_if(status = 'Cancelled') AS can, count(*) AS n
           FROM b_orders GROUP BY warehouse_id) q ON q.warehouse_id = r.warehouse_id
JOIN b_warehouses w ON w.warehouse_id = r.warehouse_id
ORDER BY total_revenue DESC, r.warehouse_id
""", _DELIVERED_FACTS)


def _usd0(x: str) -> str:
    return f"printf('$%,.0f', round_even({x}, 0))"


SQL["query_headlines"] = f"""
SELECT * FROM (SELECT 1 AS question, 'Warehouse with the highest revenue' AS title,
       printf('%s leads with %s of revenue; %s%% of its orders came back.', warehouse_name,
              {_usd0('total_revenue')}, CAST(return_rate_pct AS VARCHAR)) AS headline
FROM ({Q['warehouse_performance']}) ORDER BY total_revenue DESC, warehouse_id LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 2, 'Best-selling product',
       printf('%s in %s earned %s on %d units.', sku, category, {_usd0('total_revenue')}, units_sold)
FROM ({Q['top_revenue_products']}) ORDER BY total_revenue DESC, product_id LIMIT 1)
UNION ALL
SELECT 3, 'Positions under their reorder point',
       printf('%d positions are listed, the most urgent first.', count(*))
FROM ({Q['stockout_risk']})
UNION ALL
SELECT * FROM (SELECT 4, 'Supplier with the most late deliveries',
       printf('%s delivered %s%% of its orders late, of %d in all.', supplier_name,
              CAST(late_delivery_rate_pct AS VARCHAR), total_purchase_orders)
FROM ({Q['supplier_reliability']}) ORDER BY late_delivery_rate_pct DESC NULLS LAST, supplier_id LIMIT 1)
UNION ALL
SELECT 5, 'Money bound in dead stock',
       printf('Unsold stock adds up to %s.', {_usd0('sum(dead_stock_value)')})
FROM ({Q['dead_stock_value']})
UNION ALL
SELECT * FROM (SELECT 6, 'Largest reorder',
       printf('Of %d listed reorders the largest is %d units of %s.',
              count(*) OVER (), recommended_order_quantity, sku)
FROM ({Q['reorder_recommendations']}) ORDER BY recommended_order_quantity DESC, product_id, warehouse_name LIMIT 1)
"""

SQL["report_facts"] = f"""
SELECT * FROM (
    SELECT 'class_a_sku_count' AS fact, CAST(sku_count AS VARCHAR) AS value FROM ({A['abc_summary']}) WHERE abc_class = 'A'
    UNION ALL SELECT 'class_a_pct_of_skus', printf('%.2f', pct_of_skus) FROM ({A['abc_summary']}) WHERE abc_class = 'A'
    UNION ALL SELECT 'class_a_pct_of_revenue', printf('%.2f', pct_of_revenue) FROM ({A['abc_summary']})
              WHERE abc_class = 'A'
)
UNION ALL SELECT 'high_risk_suppliers', CAST(count_if(risk_tier = 'High Risk') AS VARCHAR)
          FROM ({A['supplier_scorecard']})
UNION ALL SELECT 'suppliers_scored', CAST(count(*) AS VARCHAR) FROM ({A['supplier_scorecard']})
UNION ALL SELECT * FROM (SELECT 'worst_supplier', supplier_name FROM ({A['supplier_scorecard']})
          ORDER BY composite_score, supplier_id LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'worst_supplier_score', printf('%.2f', composite_score)
          FROM ({A['supplier_scorecard']}) ORDER BY composite_score, supplier_id LIMIT 1)
UNION ALL SELECT 'dead_value', printf('%.2f', total_value) FROM ({A['dead_stock_summary']}) WHERE stock_status = 'Dead'
UNION ALL SELECT 'dead_pct', printf('%.2f', pct_of_inventory_value) FROM ({A['dead_stock_summary']})
          WHERE stock_status = 'Dead'
UNION ALL SELECT 'dead_plus_slow_value', printf('%.2f', CAST(sum(v) AS DOUBLE) / 100)
          FROM (SELECT category, sum(vc) AS v FROM ({with_binding('SELECT * FROM q_dead', _dead(90))})
                WHERE stock_status IN ('Dead', 'Slow-Moving') GROUP BY category)
          HAVING count(*) > 0
UNION ALL SELECT * FROM (SELECT 'worst_dead_category', category FROM (SELECT category, sum(vc) AS v
          FROM ({with_binding('SELECT * FROM q_dead', _dead(90))}) WHERE stock_status IN ('Dead', 'Slow-Moving')
          GROUP BY category) ORDER BY v DESC, category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'fastest_category', category FROM ({A['inventory_turnover']})
          WHERE inventory_turnover IS NOT NULL ORDER BY inventory_turnover DESC, category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'fastest_turnover', printf('%.2f', inventory_turnover) FROM ({A['inventory_turnover']})
          WHERE inventory_turnover IS NOT NULL ORDER BY inventory_turnover DESC, category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'slowest_category', category FROM ({A['inventory_turnover']})
          WHERE inventory_turnover IS NOT NULL ORDER BY inventory_turnover ASC, category DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'slowest_turnover', printf('%.2f', inventory_turnover) FROM ({A['inventory_turnover']})
          WHERE inventory_turnover IS NOT NULL ORDER BY inventory_turnover ASC, category DESC LIMIT 1)
"""

_FACTS = f"""
SELECT 'total_revenue' AS fact, CAST(sum(rev_c) AS DOUBLE) / 100 AS x FROM q_sales
UNION ALL SELECT 'total_margin', CAST(sum(rev_c - cogs_c) AS DOUBLE) / 100 FROM q_sales
UNION ALL SELECT 'inventory_value', CAST(sum(value_c) AS DOUBLE) / 100 FROM q_inv
UNION ALL SELECT 'dead_stock_value', CAST(sum(CASE WHEN quantity_on_hand >= safety_stock * 4 THEN value_c END) AS DOUBLE) / 100 FROM q_inv
UNION ALL SELECT 'average_order_value', CAST(sum(rev_c) AS DOUBLE) / 100 / NULLIF(CAST(count(DISTINCT order_id) AS DOUBLE), 0) FROM q_sales"""
SQL["report_money_labels"] = with_binding(f"""
SELECT fact, CASE WHEN abs(x) >= 1e6 THEN printf('$%,.1fM', round_even(x / 1e6, 1)) ELSE {_usd0('x')} END AS text_label,
       CASE WHEN abs(x) >= 1e6 THEN printf('$%.1fM', round_even(x / 1e6, 1)) WHEN abs(x) >= 1e3 THEN printf('$%.0fK', round_even(x / 1e3, 0))
            ELSE printf('$%.0f', round_even(x, 0)) END AS axis_label
FROM ({_FACTS}) f""", _FAMILIES)
