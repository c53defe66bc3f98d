"""Oracle SQL for C7-C10 (ABC, turnover, supplier scorecard, dead stock)."""

from skuflow.oracle.binding import with_binding
from skuflow.oracle.sqltext import dollars, i64, pct, rhe

SQL: dict[str, str] = {}

_DELIVERED_FACTS = """
q_f AS (
    SELECT o.order_date, o.warehouse_id, ol.order_id, ol.product_id, ol.quantity,
           ol.quantity * ol.price_cents AS rc
    FROM b_order_lines ol JOIN b_orders o ON o.order_id = ol.order_id
    WHERE o.status = 'Delivered'
)"""

_ABC = _DELIVERED_FACTS + """,
q_ps AS (
    SELECT product_id, sum(rc) AS rc, sum(quantity) AS units FROM q_f GROUP BY product_id
),
q_abc AS (
    SELECT p.product_id, p.sku, p.category, s.rc, s.units,
           s.rc - CAST(p.unit_cost_cents AS HUGEINT) * s.units AS mc,
           sum(s.rc) OVER (ORDER BY s.rc DESC, p.product_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
           sum(s.rc) OVER () AS tot,
           row_number() OVER (ORDER BY s.rc DESC, p.product_id) AS rnk
    FROM q_ps s JOIN b_products p ON p.product_id = s.product_id
),
q_cls AS (
    SELECT *, CASE WHEN cum * 1000000 <= tot * 800000 THEN 'A'
                   WHEN cum * 1000000 <= tot * 950000 THEN 'B' ELSE 'C' END AS abc_class
    FROM q_abc
)"""

SQL["abc_classification"] = with_binding(f"""
SELECT product_id, sku, category, {dollars('rc')} AS total_revenue, {dollars('mc')} AS total_margin,
       {i64('units')} AS units_sold,
       CAST(rc AS DOUBLE) / CAST(tot AS DOUBLE) AS revenue_share,
       CAST(cum AS DOUBLE) / CAST(tot AS DOUBLE) AS cumulative_revenue_share,
       abc_class, rnk AS rank
FROM q_cls ORDER BY rnk
""", _ABC)

SQL["abc_summary"] = with_binding(f"""
SELECT abc_class, count(*) AS sku_count, {dollars('sum(rc)')} AS total_revenue,
       {dollars('sum(mc)')} AS total_margin, {i64('sum(units)')} AS units_sold,
       {pct('count(*)', '(SELECT count(*) FROM q_cls)')} AS pct_of_skus,
       {pct('sum(rc)', '(SELECT sum(rc) FROM q_cls)')} AS pct_of_revenue
FROM q_cls GROUP BY abc_class ORDER BY abc_class
""", _ABC)

SQL["inventory_turnover"] = with_binding(f"""
SELECT category, line_cogs, annualized_cogs, inventory_value, inventory_turnover,
       {rhe('CAST(365 AS DOUBLE) / NULLIF(inventory_turnover, 0)', 1)} AS days_of_supply
FROM (
    SELECT *, {rhe('annualized_cogs / NULLIF(inventory_value, 0)', 2)} AS inventory_turnover
    FROM (
        SELECT coalesce(c.category, v.category) AS category,
               {dollars('coalesce(c.cc, 0)')} AS line_cogs,
               {dollars('coalesce(c.cc, 0)')}
                   * (CAST(365 AS DOUBLE) / CAST((SELECT pd FROM q_period) AS DOUBLE)) AS annualized_cogs,
               {dollars('coalesce(v.vc, 0)')} AS inventory_value
        FROM q_cogs c FULL OUTER JOIN q_val v ON v.category = c.category))
ORDER BY inventory_turnover DESC NULLS LAST, category
""", _DELIVERED_FACTS + """,
q_period AS (
    SELECT greatest(date_diff('day', min(order_date), max(order_date)), 1) AS pd FROM q_f
),
q_cogs AS (
    SELECT p.category, sum(CAST(f.quantity AS HUGEINT) * p.unit_cost_cents) AS cc
    FROM q_f f JOIN b_products p ON p.product_id = f.product_id GROUP BY p.category
),
q_val AS (
    SELECT p.category, sum(CAST(i.quantity_on_hand AS HUGEINT) * p.unit_cost_cents) AS vc
    FROM b_inventory i JOIN b_products p ON p.product_id = i.product_id GROUP BY p.category
)""")

_SCORE = """
q_d AS (
    SELECT supplier_id, quantity,
           date_diff('day', expected_delivery_date, actual_delivery_date) AS d
    FROM b_purchase_orders WHERE actual_delivery_date IS NOT NULL
),
q_st AS (
    SELECT supplier_id, count(*) AS n, count_if(d > 0) AS late_pos,
           sum(greatest(d, 0)) AS ls, sum(CAST(greatest(d, 0) AS HUGEINT) * greatest(d, 0)) AS lss,
           max(greatest(d, 0)) AS mx
    FROM q_d GROUP BY supplier_id HAVING count(*) >= 5
),
q_st2 AS (
    SELECT *, CAST(ls AS DOUBLE) / CAST(n AS DOUBLE) AS avg_late,
           coalesce(sqrt(CAST(CAST(n AS HUGEINT) * lss - ls * ls AS DOUBLE)
                         / CAST(NULLIF(CAST(n AS HUGEINT) * (n - 1), 0) AS DOUBLE)), 0) AS sd
    FROM q_st
),
q_sc AS (
    SELECT *,
           CASE WHEN (SELECT max(avg_late) FROM q_st2) > 0
                THEN CAST(100 AS DOUBLE) * (1 - avg_late / (SELECT max(avg_late) FROM q_st2))
                ELSE CAST(100 AS DOUBLE) END AS delay_raw,
           CASE WHEN (SELECT max(sd) FROM q_st2) > 0
                THEN CAST(100 AS DOUBLE) * (1 - sd / (SELECT max(sd) FROM q_st2))
                ELSE CAST(100 AS DOUBLE) END AS cons_raw,
           round_even((1 - CAST(late_pos AS DOUBLE) / CAST(n AS DOUBLE)) * CAST(100 AS DOUBLE), 2)
               AS on_time_score
    FROM q_st2
),
q_comp AS (
    SELECT *, round_even(CAST(0.5 AS DOUBLE) * on_time_score + CAST(0.3 AS DOUBLE) * delay_raw
                         + CAST(0.2 AS DOUBLE) * cons_raw, 2) AS composite_score
    FROM q_sc
),
q_card AS (
    SELECT c.supplier_id, s.name AS supplier_name, s.region, s.primary_category,
           c.n AS delivered_pos, c.late_pos,
           round_even(CAST(100 * c.late_pos AS DOUBLE) / CAST(c.n AS DOUBLE), 2) AS late_delivery_rate_pct,
           round_even(c.avg_late, 2) AS avg_delay_days, CAST(c.mx AS BIGINT) AS max_delay_days,
           c.on_time_score, round_even(c.delay_raw, 2) AS delay_score,
           round_even(c.cons_raw, 2) AS consistency_score, c.composite_score,
           CASE WHEN c.composite_score >= 85 THEN 'Preferred'
                WHEN c.composite_score >= 65 THEN 'Monitor' ELSE 'High Risk' END AS risk_tier,
           s.base_reliability_score
    FROM q_comp c LEFT JOIN b_suppliers s ON s.supplier_id = c.supplier_id
)"""

SQL["supplier_scorecard"] = with_binding("""
SELECT * FROM q_card ORDER BY composite_score, supplier_id
""", _SCORE)

SQL["scorecard_audit"] = with_binding("""
SELECT correlation, suppliers_scored,
       CASE WHEN correlation > 0.7 THEN 'Strong - the scorecard recovers the underlying reliability well'
            WHEN correlation > 0.4 THEN 'Moderate - scorecard partially recovers underlying reliability'
            ELSE 'Weak - methodology may need review' END AS interpretation
FROM (
    SELECT round_even(covar_pop(composite_score, base_reliability_score)
                      / NULLIF(stddev_pop(composite_score) * stddev_pop(base_reliability_score), 0), 3)
               AS correlation,
           count(*) AS suppliers_scored
    FROM q_card)
""", _SCORE)


def _dead(window: int) -> str:
    return _DELIVERED_FACTS + f""",
q_snap AS (SELECT max(order_date) AS s FROM q_f),
q_vel AS (
    SELECT warehouse_id, product_id, sum(quantity) AS u FROM q_f
    WHERE order_date >= (SELECT s FROM q_snap) - {window}
    GROUP BY warehouse_id, product_id
),
q_pos AS (
    SELECT i.warehouse_id, w.name AS warehouse_name, i.product_id, p.sku, p.category,
           i.quantity_on_hand, p.safety_stock,
           round_even(CAST(i.quantity_on_hand AS DOUBLE) / NULLIF(CAST(p.safety_stock AS DOUBLE), 0), 2)
               AS stock_ratio,
           p.unit_cost_cents, CAST(i.quantity_on_hand AS BIGINT) * p.unit_cost_cents AS vc,
           CAST(coalesce(v.u, 0) AS BIGINT) AS units_sold_recent,
           CAST(coalesce(v.u, 0) AS DOUBLE) / CAST({window} AS DOUBLE) AS daily_demand,
           CAST(date_diff('day', i.last_restock_date, (SELECT s FROM q_snap)) AS INTEGER) AS days_since_restock
    FROM b_inventory i
    JOIN b_products p ON p.product_id = i.product_id
    JOIN b_warehouses w ON w.warehouse_id = i.warehouse_id
    LEFT JOIN q_vel v ON v.warehouse_id = i.warehouse_id AND v.product_id = i.product_id
),
q_ds AS (
    SELECT *, CASE WHEN daily_demand > 0
                   THEN round_even(CAST(quantity_on_hand AS DOUBLE) / daily_demand, 1) END AS days_of_supply
    FROM q_pos
),
q_dead AS (
    SELECT *, CASE WHEN units_sold_recent = 0 AND stock_ratio >= 2 THEN 'Dead'
                   WHEN days_of_supply > 180 THEN 'Slow-Moving'
                   WHEN stock_ratio >= 4 THEN 'Overstocked' ELSE 'Healthy' END AS stock_status
    FROM q_ds
)"""


SQL["dead_stock_detail"] = with_binding(f"""
SELECT warehouse_id, warehouse_name, product_id, sku, category, quantity_on_hand, safety_stock,
       stock_ratio, {dollars('unit_cost_cents')} AS unit_cost, {dollars('vc')} AS inventory_value,
       units_sold_recent, daily_demand, days_of_supply, days_since_restock, stock_status
FROM q_dead ORDER BY inventory_value DESC, warehouse_id, product_id
""", _dead(90))

SQL["dead_stock_summary"] = with_binding(f"""
SELECT stock_status, count(*) AS positions, {i64('sum(quantity_on_hand)')} AS total_units,
       {dollars('sum(vc)')} AS total_value,
       {pct('sum(vc)', '(SELECT sum(vc) FROM q_dead)')} AS pct_of_inventory_value
FROM q_dead GROUP BY stock_status ORDER BY total_value DESC, stock_status
""", _dead(90))

SQL["dead_stock_by_category"] = with_binding(f"""
SELECT category, count(*) AS problem_positions, {dollars('sum(vc)')} AS capital_tied_up
FROM q_dead WHERE stock_status IN ('Dead', 'Slow-Moving')
GROUP BY category ORDER BY capital_tied_up DESC, category
""", _dead(90))

SQL["risk_tier_counts"] = with_binding("""
SELECT risk_tier, count(*) AS suppliers FROM q_card GROUP BY risk_tier ORDER BY suppliers DESC, risk_tier
""", _SCORE)
