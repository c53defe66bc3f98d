"""The FIXTURES.md part B binding written as DuckDB CTEs.

Kept free of any Spark code on purpose: it is the second, independent
statement of the binding that the Spark build is checked against.
"""

BINDING_CTES = """
b_warehouses AS (
    SELECT CAST(r_regionkey AS BIGINT) AS warehouse_id, r_name AS name, r_name AS region,
           CAST(100000 * (1 + r_regionkey) AS INTEGER) AS capacity_units
    FROM region
),
b_orders AS (
    SELECT CAST(o.o_orderkey AS BIGINT) AS order_id,
           CAST(o.o_orderdate AS DATE) AS order_date,
           CAST(n.n_regionkey AS BIGINT) AS warehouse_id,
           CAST(o.o_custkey AS BIGINT) AS customer_id,
           CASE o.o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Returned'
                                WHEN 'O' THEN 'Cancelled' END AS status
    FROM orders o
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
),
b_li AS (
    SELECT l_orderkey * 1048576 + row_number() OVER (
               PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS line_id,
           l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           (CAST(round(100 * l_extendedprice) AS BIGINT)
              * (100 - CAST(round(100 * l_discount) AS BIGINT)))
              // (100 * CAST(l_quantity AS INTEGER)) AS price_cents,
           CAST(l_shipdate AS DATE) AS ship_date,
           CAST(round(100 * l_tax) AS INTEGER) AS tax_pct
    FROM lineitem
),
b_order_lines AS (
    SELECT line_id AS order_line_id, order_id, product_id, quantity, price_cents FROM b_li
),
b_po_raw AS (
    SELECT line_id AS po_id, supplier_id, product_id, ship_date AS order_date, quantity,
           ship_date + CAST(60 + 20 * (supplier_id % 14) AS INTEGER) AS expected_delivery_date,
           ship_date + CAST(60 + 20 * (supplier_id % 14)
                            + tax_pct * greatest(supplier_id % 10 - 5, 0) - 12 AS INTEGER) AS arrival
    FROM b_li
),
b_purchase_orders AS (
    SELECT po_id, supplier_id, product_id, order_date, expected_delivery_date,
           CASE WHEN arrival <= (SELECT max(ship_date) FROM b_li) THEN arrival END AS actual_delivery_date,
           quantity
    FROM b_po_raw
),
b_pair_units AS (
    SELECT l_partkey AS product_id, l_suppkey AS supplier_id,
           sum(CAST(l_quantity AS INTEGER)) AS units
    FROM lineitem GROUP BY l_partkey, l_suppkey
),
b_part_supplier AS (
    SELECT product_id, supplier_id FROM (
        SELECT product_id, supplier_id,
               row_number() OVER (PARTITION BY product_id ORDER BY units DESC, supplier_id) AS rn
        FROM b_pair_units) WHERE rn = 1
),
b_part_total AS (
    SELECT product_id, sum(units) AS units FROM b_pair_units GROUP BY product_id
),
b_supplier_cat AS (
    SELECT supplier_id, p_type AS primary_category FROM (
        SELECT pu.supplier_id, p.p_type,
               row_number() OVER (PARTITION BY pu.supplier_id ORDER BY sum(pu.units) DESC, p.p_type) AS rn
        FROM b_pair_units pu JOIN part p ON p.p_partkey = pu.product_id
        GROUP BY pu.supplier_id, p.p_type) WHERE rn = 1
),
b_suppliers AS (
    SELECT CAST(s.s_suppkey AS BIGINT) AS supplier_id, s.s_name AS name, r.r_name AS region,
           sc.primary_category,
           CAST(95 - 15 * greatest(s.s_suppkey % 10 - 5, 0) AS DOUBLE) / 100 AS base_reliability_score,
           CAST(60 + 20 * (s.s_suppkey % 14) AS INTEGER) AS avg_lead_time_days
    FROM supplier s
    JOIN nation n ON n.n_nationkey = s.s_nationkey
    JOIN region r ON r.r_regionkey = n.n_regionkey
    LEFT JOIN b_supplier_cat sc ON sc.supplier_id = s.s_suppkey
),
b_bounds AS (
    SELECT greatest(date_diff('day', min(order_date), max(order_date)), 1) AS period_days,
           max(order_date) AS max_date
    FROM b_orders
),
b_products_base AS (
    SELECT CAST(p.p_partkey AS BIGINT) AS product_id,
           upper(substr(p.p_type, 1, 3)) || '-' || lpad(CAST(p.p_partkey + 1 AS VARCHAR), CAST(greatest(5, length(CAST(p.p_partkey + 1 AS VARCHAR))) AS INTEGER), '0') AS sku,
           p.p_type AS category,
           CAST(round(p.p_retailprice * 73) AS BIGINT) AS unit_cost_cents,
           CAST(round(p.p_retailprice * 100) AS BIGINT) AS unit_price_cents,
           ps.supplier_id,
           CAST(coalesce(pt.units, 0) AS DOUBLE) / (SELECT period_days FROM b_bounds)
               / (SELECT count(*) FROM b_warehouses) * (60 + 20 * (ps.supplier_id % 14)) AS ltd
    FROM part p
    LEFT JOIN b_part_total pt ON pt.product_id = p.p_partkey
    LEFT JOIN b_part_supplier ps ON ps.product_id = p.p_partkey
),
b_products_ss AS (
    SELECT *, CAST(greatest(ceil(ltd * 0.5), 2) AS INTEGER) AS safety_stock FROM b_products_base
),
b_products AS (
    SELECT product_id, sku, category, unit_cost_cents, unit_price_cents, supplier_id,
           CAST(greatest(ceil(ltd + safety_stock), safety_stock + 1) AS INTEGER) AS reorder_point,
           safety_stock, CAST(NULL AS DOUBLE) AS popularity_score
    FROM b_products_ss
),
b_positions AS (
    SELECT w.warehouse_id, p.product_id, p.reorder_point, p.safety_stock,
           (p.product_id * 37 + w.warehouse_id * 53 + (p.product_id % 7) * 11) % 100 AS bkt
    FROM b_products p CROSS JOIN b_warehouses w
),
b_inventory AS (
    SELECT warehouse_id, product_id,
           CAST(CASE WHEN bkt < 12 THEN (reorder_point * (10 + 7 * bkt)) // 100
                     WHEN bkt < 22 THEN safety_stock * (4 + bkt % 5)
                     ELSE reorder_point + 1 + (safety_stock * (bkt % 10)) // 20 END AS INTEGER)
               AS quantity_on_hand,
           (SELECT max_date FROM b_bounds)
               - CAST(1 + (product_id * 13 + warehouse_id * 29) % 119 AS INTEGER) AS last_restock_date
    FROM b_positions
)
"""


def with_binding(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the binding CTEs (plus optional query-level CTEs)."""
    ctes = BINDING_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"
