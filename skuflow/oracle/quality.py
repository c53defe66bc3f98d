"""Oracle SQL for the data-quality checks (Q1-Q13, Q19-Q24)."""

from skuflow.oracle.analysis import _SCORE, _ABC
from skuflow.oracle.binding import with_binding
from skuflow.oracle.star import _DIM_PRODUCT, _DIM_SUPPLIER
from skuflow.operators.quality import (BANDS, CHECK_CONSTRAINTS, DEFAULT_ORDER_WINDOW, FOREIGN_KEYS,
                                       PRIMARY_KEYS)
from skuflow.sources.schemas import MODEL_SCHEMAS

SQL: dict[str, str] = {}

_T = {"warehouses": "b_warehouses", "suppliers": "b_suppliers", "products": "b_products",
      "inventory": "b_inventory", "purchase_orders": "b_purchase_orders", "orders": "b_orders",
      "order_lines": "b_order_lines"}


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _pk():
    parts = []
    for table, keys in PRIMARY_KEYS:
        k = ", ".join(keys)
        anynull = " OR ".join(f"{c} IS NULL" for c in keys)
        parts.append(
            f"SELECT '{table}({k}) is unique' AS \"check\", d = 0 AND z = 0 AS passed, "
            f"printf('%d duplicate keys, %d null keys', d, z) AS detail FROM "
            f"(SELECT count(*) AS d FROM (SELECT {k} FROM {_T[table]} GROUP BY {k} HAVING count(*) > 1)), "
            f"(SELECT count_if({anynull}) AS z FROM {_T[table]})")
    return _union(parts)


def _not_null():
    parts = []
    for table, schema in MODEL_SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                parts.append(
                    f"SELECT '{table}.{f.name} is not null' AS \"check\", n = 0 AS passed, "
                    f"printf('%d nulls', n) AS detail FROM (SELECT count_if({f.name} IS NULL) AS n FROM {_T[table]})")
    return _union(parts)


def _checks():
    parts = []
    for table, rules in CHECK_CONSTRAINTS.items():
        for label, expr in rules:
            parts.append(
                f"SELECT '{table}: {label}' AS \"check\", n = 0 AS passed, printf('%d violations', n) AS detail "
                f"FROM (SELECT count_if(NOT ({expr})) AS n FROM {_T[table]})")
    return _union(parts)


def _fk():
    parts = []
    for child, col, parent, key in FOREIGN_KEYS:
        parts.append(
            f"SELECT '{child}.{col} references {parent}' AS \"check\", n = 0 AS passed, "
            f"printf('%d orphans', n) AS detail FROM (SELECT count(*) AS n FROM {_T[child]} c "
            f"WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_T[parent]} p WHERE p.{key} = c.{col}))")
    return _union(parts)


def _share(name, k, n, lo, hi=None):
    share = f"(CAST(1 AS DOUBLE) * {k})" if n is None else f"(CAST({k} AS DOUBLE) / NULLIF(CAST({n} AS DOUBLE), 0))"
    ok = f"{share} >= {lo} AND {share} <= {hi}" if hi is not None else f"{share} >= {lo}"
    return (f"SELECT '{name}' AS \"check\", coalesce({ok}, false) AS passed, "
            f"printf('got %.1f%%', round_even({share} * 100, 1)) AS detail")


SQL["dq_pk"] = with_binding(_pk())
SQL["dq_not_null"] = with_binding(_not_null())
SQL["dq_check"] = with_binding(_checks())
SQL["dq_domain"] = with_binding(
    "SELECT 'orders.status in domain' AS \"check\", n = 0 AS passed, printf('%d violations', n) AS detail "
    "FROM (SELECT count_if(status IS NULL OR status NOT IN ('Delivered', 'Cancelled', 'Returned')) AS n "
    "FROM b_orders)")
SQL["dq_fk"] = with_binding(_fk())
SQL["dq_fk_violations"] = with_binding(_union([
    f"SELECT * FROM (SELECT DISTINCT '{c}.{col}' AS relation, CAST(x.{col} AS BIGINT) AS key FROM {_T[c]} x "
    f"WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_T[p]} y WHERE y.{k} = x.{col}) "
    f"ORDER BY key LIMIT 10)" for c, col, p, k in FOREIGN_KEYS]))
SQL["dq_row_counts"] = with_binding(_union([
    f"SELECT '{t} has expected row count' AS \"check\", n = e AS passed, printf('%d of %d', n, e) AS detail "
    f"FROM (SELECT count(*) AS n FROM {_T[t]}), (SELECT count(*) AS e FROM {src})"
    for t, src in (("warehouses", "region"), ("suppliers", "supplier"), ("products", "part"),
                   ("orders", "orders"))]))
SQL["dq_dates_window"] = with_binding(
    f"SELECT 'orders dated inside the expected window' AS \"check\", n = 0 AS passed, "
    f"printf('%d outside', n) AS detail FROM (SELECT count_if(NOT (order_date BETWEEN DATE "
    f"'{DEFAULT_ORDER_WINDOW[0]}' AND DATE '{DEFAULT_ORDER_WINDOW[1]}')) AS n FROM b_orders)")

_ON_TIME = ("(SELECT CAST(1 AS DOUBLE) - CAST(count_if(actual_delivery_date > expected_delivery_date) AS DOUBLE)"
            " / NULLIF(CAST(count(*) AS DOUBLE), 0) AS s FROM b_purchase_orders"
            " WHERE actual_delivery_date IS NOT NULL)")
SQL["dq_on_time_share"] = with_binding(
    _share("on-time share of delivered purchase orders within its band", "s", None, *BANDS["on_time"])
    + f" FROM {_ON_TIME}")
_POS = "(SELECT i.quantity_on_hand, p.reorder_point, p.safety_stock FROM b_inventory i JOIN b_products p " \
       "ON p.product_id = i.product_id)"
SQL["dq_stockout_share"] = with_binding(
    _share("share of positions under the reorder point within its band", "k", "n", *BANDS["stockout"])
    + f" FROM (SELECT count_if(quantity_on_hand < reorder_point) AS k, count(*) AS n FROM {_POS})")
SQL["dq_dead_share"] = with_binding(
    _share("share of dead positions within its band", "k", "n", *BANDS["dead"])
    + f" FROM (SELECT count_if(quantity_on_hand >= safety_stock * 4) AS k, count(*) AS n FROM {_POS})")
SQL["dq_top20_share"] = with_binding(
    _share("revenue share of the best fifth of products reaches its band", "top", "total", BANDS["top20"])
    + """ FROM (
    SELECT sum(CASE WHEN rnk <= greatest(1, (2 * n) // 10) THEN rev END) AS top, sum(rev) AS total
    FROM (SELECT rev, row_number() OVER (ORDER BY rev DESC, product_id) AS rnk, count(*) OVER () AS n
          FROM (SELECT product_id, sum(quantity * price_cents) AS rev FROM b_order_lines GROUP BY product_id)))""")
SQL["dq_po_dates"] = with_binding(
    "SELECT 'delivered POs arrive on or after the order date' AS \"check\", n = 0 AS passed, "
    "printf('%d violations', n) AS detail FROM (SELECT count_if(actual_delivery_date < order_date) AS n "
    "FROM b_purchase_orders)")
SQL["dq_basket_stability"] = with_binding("""
SELECT 'lines per order is stable over time' AS "check",
       coalesce(abs(first_mean - second_mean) < 0.4, false) AS passed,
       printf('first %.3f, second %.3f', round_even(first_mean, 3), round_even(second_mean, 3)) AS detail
FROM (
    SELECT avg(CASE WHEN NOT second THEN n_lines END) AS first_mean,
           avg(CASE WHEN second THEN n_lines END) AS second_mean
    FROM (
        SELECT o.order_id, nl.n_lines,
               CAST(date_diff('day', DATE '1970-01-01', o.order_date) AS DOUBLE)
                   >= (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', order_date), 0.5) FROM b_orders)
                   AS second
        FROM b_orders o
        LEFT JOIN (SELECT order_id, count(*) AS n_lines FROM b_order_lines GROUP BY order_id) nl
               ON nl.order_id = o.order_id))
""")
SQL["dq_month_basket_corr"] = with_binding("""
SELECT 'order month and basket size are independent' AS "check", coalesce(abs(r) < 0.05, false) AS passed,
       printf('r = %.3f', r) AS detail
FROM (
    SELECT round_even(covar_pop(mi, nl) / NULLIF(stddev_pop(mi) * stddev_pop(nl), 0), 3) AS r
    FROM (SELECT CAST(year(o.order_date) * 12 + month(o.order_date) AS DOUBLE) AS mi,
                 CAST(l.n_lines AS DOUBLE) AS nl
          FROM b_orders o JOIN (SELECT order_id, count(*) AS n_lines FROM b_order_lines GROUP BY order_id) l
               ON l.order_id = o.order_id))
""")
SQL["dq_revenue_reconcile"] = with_binding("""
SELECT 'warehouse revenue reconciles with order lines' AS "check", r = t AS passed,
       printf('report %s, lines %s', CAST(r AS VARCHAR), CAST(t AS VARCHAR)) AS detail
FROM (SELECT sum(rc) AS r FROM (SELECT o.order_id, r.rc FROM b_orders o JOIN
        (SELECT order_id, sum(quantity * price_cents) AS rc FROM b_order_lines GROUP BY order_id) r
        ON r.order_id = o.order_id)),
     (SELECT sum(quantity * price_cents) AS t FROM b_order_lines)
""")
SQL["dq_dead_reconcile"] = with_binding(f"""
SELECT 'dead-stock units reconcile with inventory' AS "check", r = t AS passed,
       printf('report %d, inventory %d', r, t) AS detail
FROM (SELECT CAST(sum(u) AS BIGINT) AS r FROM (SELECT p.category, sum(i.quantity_on_hand) AS u
        FROM b_inventory i JOIN b_products p ON p.product_id = i.product_id
        WHERE i.quantity_on_hand >= p.safety_stock * 4 GROUP BY p.category)),
     (SELECT CAST(sum(quantity_on_hand) AS BIGINT) AS t FROM {_POS} WHERE quantity_on_hand >= safety_stock * 4)
""")
SQL["dq_labels"] = with_binding("""
SELECT 'abc_class labels valid' AS "check", n = 0 AS passed, printf('%d invalid', n) AS detail
FROM (SELECT count_if(NOT coalesce(abc_class IN ('A', 'B', 'C'), false)) AS n FROM q_dim_product)
UNION ALL
SELECT 'risk_tier labels valid' AS "check", n = 0 AS passed, printf('%d invalid', n) AS detail
FROM (SELECT count_if(NOT coalesce(risk_tier IN ('Preferred', 'Monitor', 'High Risk', 'Insufficient Data'),
                                   false)) AS n FROM q_dim_supplier)
""", _ABC + "," + _SCORE + "," + _DIM_PRODUCT + "," + _DIM_SUPPLIER)

_GEN_PARTS = ["dq_row_counts", "dq_fk", "dq_check", "dq_dates_window", "dq_on_time_share", "dq_stockout_share",
              "dq_dead_share", "dq_top20_share"]
SQL["dq_generation_report"] = " UNION ALL ".join(f"SELECT * FROM ({SQL[k]})" for k in _GEN_PARTS)
SQL["dq_generation_verdict"] = (
    "SELECT bool_and(passed) AS all_passed, count_if(NOT passed) AS failed_checks, count(*) AS checks "
    f"FROM ({SQL['dq_generation_report']})")
