"""Oracle SQL for the measure library (M1-M37) and time intelligence."""

from skuflow.oracle.analysis import _ABC, _SCORE
from skuflow.oracle.binding import with_binding
from skuflow.oracle.star import _DIM_DATE

SQL: dict[str, str] = {}

_FAMILIES = _ABC + "," + _SCORE + "," + _DIM_DATE + """,
q_pdim AS (
    SELECT p.product_id, p.sku, p.category, p.unit_cost_cents, p.reorder_point, p.safety_stock,
           coalesce(c.abc_class, 'C') AS abc_class
    FROM b_products p LEFT JOIN q_cls c ON c.product_id = p.product_id
),
q_wdim AS (SELECT warehouse_id, name AS warehouse_name, region AS warehouse_region FROM b_warehouses),
q_sdim AS (
    SELECT s.supplier_id, s.name AS supplier_name, s.region AS supplier_region,
           coalesce(c.risk_tier, 'Insufficient Data') AS risk_tier
    FROM b_suppliers s LEFT JOIN q_card c ON c.supplier_id = s.supplier_id
),
q_lines_all AS (
    SELECT ol.order_id, ol.product_id, ol.quantity, o.status, o.order_date, o.warehouse_id,
           ol.quantity * ol.price_cents AS rev_c,
           CAST(ol.quantity AS BIGINT) * p.unit_cost_cents AS cogs_c,
           strftime(o.order_date, '%Y-%m') AS year_month, year(o.order_date) AS year,
           p.sku, p.category, p.abc_class, w.warehouse_name, w.warehouse_region
    FROM b_order_lines ol
    JOIN b_orders o ON o.order_id = ol.order_id
    JOIN q_pdim p ON p.product_id = ol.product_id
    JOIN q_wdim w ON w.warehouse_id = o.warehouse_id
),
q_sales AS (SELECT * FROM q_lines_all WHERE status = 'Delivered'),
q_inv AS (
    SELECT i.quantity_on_hand, p.reorder_point, p.safety_stock, p.category, p.sku, p.abc_class,
           w.warehouse_name, w.warehouse_region,
           CAST(i.quantity_on_hand AS BIGINT) * p.unit_cost_cents AS value_c
    FROM b_inventory i JOIN q_pdim p ON p.product_id = i.product_id
    JOIN q_wdim w ON w.warehouse_id = i.warehouse_id
),
q_po AS (
    SELECT po.supplier_id, s.supplier_name, s.supplier_region, s.risk_tier, p.category, p.sku, p.abc_class,
           strftime(po.order_date, '%Y-%m') AS year_month, year(po.order_date) AS year,
           date_diff('day', po.expected_delivery_date, po.actual_delivery_date) AS delay_days,
           po.actual_delivery_date IS NOT NULL AS is_delivered,
           coalesce(date_diff('day', po.expected_delivery_date, po.actual_delivery_date) > 0, false) AS is_late
    FROM b_purchase_orders po JOIN q_sdim s ON s.supplier_id = po.supplier_id
    JOIN q_pdim p ON p.product_id = po.product_id
)"""

# family -> list of (column, aggregate SQL)
_AGGS = {
    "q_sales": [
        ("_rev_c", "sum(rev_c)"), ("_margin_c", "sum(rev_c - cogs_c)"), ("_cogs_c", "sum(cogs_c)"),
        ("_lines", "count(*)"), ("total_units_sold", "CAST(sum(quantity) AS BIGINT)"),
        ("order_count", "count(DISTINCT order_id)"),
        ("_a_rev_c", "sum(CASE WHEN abc_class = 'A' THEN rev_c END)"),
    ],
    "q_lines_all": [
        ("returned_orders", "count(DISTINCT CASE WHEN status = 'Returned' THEN order_id END)"),
        ("_orders_all", "count(DISTINCT order_id)"),
        ("delivered_revenue", "CAST(sum(CASE WHEN status = 'Delivered' THEN rev_c END) AS DOUBLE) / 100"),
    ],
    "q_inv": [
        ("_inv_c", "sum(value_c)"),
        ("_dead_c", "sum(CASE WHEN quantity_on_hand >= safety_stock * 4 THEN value_c END)"),
        ("_positions", "count(*)"), ("units_on_hand", "CAST(sum(quantity_on_hand) AS BIGINT)"),
        ("skus_below_reorder_point", "count_if(quantity_on_hand < reorder_point)"),
    ],
    "q_po": [
        ("purchase_order_count", "count(*)"), ("delivered_pos", "count_if(is_delivered)"),
        ("late_pos", "count_if(is_late)"),
        ("average_delay_days", "CAST(sum(CASE WHEN is_delivered THEN delay_days END) AS DOUBLE)"
                               " / NULLIF(CAST(count(CASE WHEN is_delivered THEN delay_days END) AS DOUBLE), 0)"),
    ],
    "q_sdim": [("high_risk_suppliers", "count(DISTINCT CASE WHEN risk_tier = 'High Risk' THEN supplier_id END)")],
    "q_pdim": [("class_a_sku_count", "count(DISTINCT CASE WHEN abc_class = 'A' THEN product_id END)")],
    "q_dim_date": [("selected_period_label",
                    "strftime(min(date), '%b %Y') || ' – ' || strftime(max(date), '%b %Y')")],
}


def _ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


# Derived (post-merge) measures.
_DERIVED = {
    "total_revenue": "CAST(_rev_c AS DOUBLE) / 100",
    "total_margin": "CAST(_margin_c AS DOUBLE) / 100",
    "total_cogs": "CAST(_cogs_c AS DOUBLE) / 100",
    "margin_pct": _ratio("_margin_c", "_rev_c"),
    "average_order_value": "(CAST(_rev_c AS DOUBLE) / 100) / NULLIF(CAST(order_count AS DOUBLE), 0)",
    "lines_per_order": _ratio("_lines", "order_count"),
    "return_rate": _ratio("returned_orders", "_orders_all"),
    "inventory_value": "CAST(_inv_c AS DOUBLE) / 100",
    "stockout_risk_pct": _ratio("skus_below_reorder_point", "_positions"),
    "inventory_turnover": _ratio("_cogs_c", "_inv_c"),
    "days_of_supply": f"CAST(365 AS DOUBLE) / NULLIF({_ratio('_cogs_c', '_inv_c')}, 0)",
    "dead_stock_value": "CAST(_dead_c AS DOUBLE) / 100",
    "dead_stock_pct": _ratio("_dead_c", "_inv_c"),
    "late_delivery_rate": _ratio("late_pos", "delivered_pos"),
    "on_time_delivery_rate": f"CAST(1 AS DOUBLE) - coalesce({_ratio('late_pos', 'delivered_pos')}, 0)",
    "class_a_revenue": "CAST(_a_rev_c AS DOUBLE) / 100",
}


def measures_sql(families: list[str], measures: list[str], by: list[str]) -> str:
    cols = [c for f in families for c, _ in _AGGS[f]]
    parts = []
    for f in families:
        own = dict(_AGGS[f])
        sel = [*by] + [f"{own[c]} AS {c}" if c in own else f"NULL AS {c}" for c in cols]
        group = f" GROUP BY {', '.join(by)}" if by else ""
        parts.append(f"SELECT {', '.join(sel)} FROM {f}{group}")
    union = "\nUNION ALL\n".join(parts)
    merged = ", ".join([*by] + [f"max({c}) AS {c}" for c in cols])
    group = f" GROUP BY {', '.join(by)}" if by else ""
    final = [*by] + [f"{_DERIVED[m_]} AS {m_}" if m_ in _DERIVED else m_ for m_ in measures]
    return with_binding(
        f"SELECT {', '.join(final)} FROM (SELECT {merged} FROM ({union}) u{group}) mm",
        _FAMILIES)


def time_intelligence_sql(by: list[str]) -> str:
    keys = ", ".join(by)
    kp = (keys + ", ") if by else ""
    part = f"PARTITION BY {keys} " if by else ""
    join_on = " AND ".join([f"s.{k} = mo.{k}" for k in by] + ["s.month_start = mo.month_start"])
    ctx_src = f"SELECT DISTINCT {keys} FROM q_month" if by else "SELECT 1 AS one"
    ctx_cols = ", ".join(f"c.{k}" for k in by)
    return with_binding(f"""
SELECT {kp}year_month, revenue, revenue_ytd, revenue_py, revenue_yoy_pct, revenue_pm, revenue_mom_pct,
       revenue_3m_avg,
       CASE WHEN revenue_yoy_pct IS NULL THEN ''
            WHEN revenue_yoy_pct > 0 THEN '▲ ' || printf('%.1f%%', round_even(revenue_yoy_pct * 100, 1))
            WHEN revenue_yoy_pct < 0 THEN '▼ ' || printf('%.1f%%', round_even(revenue_yoy_pct * 100, 1))
            ELSE '– 0.0%' END AS revenue_yoy_arrow
FROM (
    SELECT {kp}strftime(month_start, '%Y-%m') AS year_month,
           CAST(rc AS DOUBLE) / 100 AS revenue,
           CAST(sum(rc) OVER (PARTITION BY {kp}year(month_start) ORDER BY month_start
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100 AS revenue_ytd,
           CAST(lag(rc, 12) OVER w AS DOUBLE) / 100 AS revenue_py,
           CAST(coalesce(rc, 0) - lag(rc, 12) OVER w AS DOUBLE)
               / NULLIF(CAST(lag(rc, 12) OVER w AS DOUBLE), 0) AS revenue_yoy_pct,
           CAST(lag(rc, 1) OVER w AS DOUBLE) / 100 AS revenue_pm,
           CAST(coalesce(rc, 0) - lag(rc, 1) OVER w AS DOUBLE)
               / NULLIF(CAST(lag(rc, 1) OVER w AS DOUBLE), 0) AS revenue_mom_pct,
           CAST(sum(rc) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) / 100
               / NULLIF(CAST(sum(sales_days) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE), 0)
               AS revenue_3m_avg
    FROM q_filled
    WINDOW w AS ({part}ORDER BY month_start)
) t
ORDER BY {kp}year_month
""", _FAMILIES + f""",
q_day AS (
    SELECT {kp}order_date, sum(rev_c) AS day_c FROM q_sales GROUP BY {kp}order_date
),
q_month AS (
    SELECT {kp}CAST(date_trunc('month', order_date) AS DATE) AS month_start,
           sum(day_c) AS rc, count(*) AS sales_days
    FROM q_day GROUP BY {kp}CAST(date_trunc('month', order_date) AS DATE)
),
q_months AS (
    SELECT CAST(unnest(generate_series(
               CAST(make_date(year((SELECT min(month_start) FROM q_month)), 1, 1) AS TIMESTAMP),
               CAST(make_date(year((SELECT max(month_start) FROM q_month)), 12, 1) AS TIMESTAMP),
               INTERVAL 1 MONTH)) AS DATE) AS month_start
),
q_spine AS (
    SELECT {ctx_cols + ", " if by else ""}m.month_start FROM ({ctx_src}) c CROSS JOIN q_months m
),
q_filled AS (
    SELECT {", ".join("s." + k for k in by) + ", " if by else ""}s.month_start, mo.rc, mo.sales_days
    FROM q_spine s LEFT JOIN q_month mo ON {join_on}
)""")


def class_a_share_sql(by: list[str], with_sku_count: bool) -> str:
    kp = (", ".join(by) + ", ") if by else ""
    group = f" GROUP BY {', '.join(by)}" if by else ""
    sku = ""
    sku_join = ""
    if with_sku_count:
        sku = ", k.class_a_sku_count"
        on = " AND ".join(f"k.{x} = a.{x}" for x in by) if by else "true"
        sku_join = (f" LEFT JOIN (SELECT {kp}count(DISTINCT CASE WHEN abc_class = 'A' THEN product_id END)"
                    f" AS class_a_sku_count FROM q_pdim{group}) k ON {on}")
    other = [x for x in by if x not in ("category", "sku", "product_id", "abc_class")]
    ogroup = f" GROUP BY {', '.join(other)}" if other else ""
    den_on = " AND ".join(f"d.{x} = a.{x}" for x in other) if other else "true"
    cols = ", ".join(f"a.{x}" for x in by)
    return with_binding(f"""
SELECT {cols + ", " if by else ""}a.class_a_revenue, a.total_revenue{sku},
       a.class_a_revenue / NULLIF(d.all_rev, 0) AS class_a_revenue_pct
FROM (SELECT {kp}CAST(sum(CASE WHEN abc_class = 'A' THEN rev_c END) AS DOUBLE) / 100 AS class_a_revenue,
             CAST(sum(rev_c) AS DOUBLE) / 100 AS total_revenue
      FROM q_sales{group}) a
LEFT JOIN (SELECT {", ".join(other) + ", " if other else ""}CAST(sum(rev_c) AS DOUBLE) / 100 AS all_rev
           FROM q_sales{ogroup}) d ON {den_on}{sku_join}
""", _FAMILIES)


_FAMILY_CTE = {"lines": "q_sales", "lines_all": "q_lines_all", "inventory": "q_inv", "purchase_orders": "q_po",
               "supplier_dim": "q_sdim", "product_dim": "q_pdim", "date_dim": "q_dim_date",
               "lines+inventory": None}


def view_sql(families, measures, by) -> str:
    ctes = []
    for f in families:
        if f == "lines+inventory":
            continue
        ctes.append(_FAMILY_CTE[f])
    if "lines+inventory" in families:
        for need in ("q_sales", "q_inv"):
            if need not in ctes:
                ctes.append(need)
    return measures_sql(ctes, list(measures), list(by))


_PERIOD_NAMES = {"day": "date_key", "month": "year_month", "quarter": "year, quarter", "year": "year", "fiscal_year": "fiscal_year"}


def _spans_ctes(grain: str, by, year_start_month: int) -> str:
    """Every span's days by a plain range join over the days with sales."""
    keys = "".join(f"{k}, " for k in by)
    same = " AND ".join([f"d.{k} IS NOT DISTINCT FROM s.{k}" for k in by] + ["d.order_date BETWEEN s.lo AND s.hi"])
    moved = "CAST({0} - INTERVAL {1} MONTH AS DATE)"
    span_rows = []
    for name, months in (("py", 12), ("pm", 1)):
        lo, hi = moved.format("lo_day", months), moved.format("hi_day", months)
        span_rows.append(f"SELECT *, '{name}' AS span, {lo} AS lo, CASE WHEN hi_day = last_day(hi_day) AND day(lo_day) = 1 "
                         f"THEN last_day({hi}) ELSE {hi} END AS hi FROM q_ctx")
    turn = f"make_date(year(hi_day) - CASE WHEN month(hi_day) < {year_start_month} THEN 1 ELSE 0 END, {year_start_month}, 1)"
    trailing = ("CASE WHEN hi_day = last_day(hi_day) THEN CAST(date_trunc('month', hi_day) - INTERVAL 2 MONTH AS DATE) "
                "ELSE CAST(hi_day - INTERVAL 3 MONTH AS DATE) + 1 END")
    span_rows += ["SELECT *, 'cur' AS span, lo_day AS lo, hi_day AS hi FROM q_ctx", f"SELECT *, 'ytd' AS span, {turn} AS lo, hi_day AS hi FROM q_ctx",
                  f"SELECT *, 'r3' AS span, {trailing} AS lo, hi_day AS hi FROM q_ctx"]
    contexts = f"(SELECT DISTINCT {', '.join(by)} FROM q_days_sold) CROSS JOIN " if by else ""
    return _FAMILIES + f""",
q_days_sold AS (SELECT {keys}order_date, sum(rev_c) AS day_c FROM q_sales GROUP BY {keys}order_date),
q_calendar AS (SELECT {_PERIOD_NAMES[grain]}, min(date) AS lo_day, max(date) AS hi_day FROM q_dim_date GROUP BY {_PERIOD_NAMES[grain]}),
q_ctx AS (SELECT * FROM {contexts}q_calendar),
q_spans AS ({" UNION ALL ".join(span_rows)}),
q_sums AS (
    SELECT {"".join(f"s.{k}, " for k in by)}s.lo_day, s.span, sum(d.day_c) AS c, count(d.order_date) AS n
    FROM q_spans s LEFT JOIN q_days_sold d ON {same} GROUP BY {"".join(f"s.{k}, " for k in by)}s.lo_day, s.span
),
q_wide AS (
    SELECT {"".join(f"x.{k}, " for k in by)}{", ".join("x." + c for c in _PERIOD_NAMES[grain].split(", "))}, x.lo_day AS first_day,
           {", ".join(f"max(CASE WHEN q.span = '{s}' THEN q.c END) AS {s}_c" for s in ("cur", "ytd", "py", "pm", "r3"))},
           max(CASE WHEN q.span = 'r3' THEN q.n END) AS r3_n
    FROM q_ctx x JOIN q_sums q ON q.lo_day = x.lo_day {"".join(f"AND q.{k} IS NOT DISTINCT FROM x.{k} " for k in by)}
    GROUP BY ALL
)"""


def period_sql(grain: str, by, year_start_month: int = 1) -> str:
    keys = "".join(f"{k}, " for k in by) + _PERIOD_NAMES[grain]

    def change(prev: str) -> str:
        return f"CAST(coalesce(cur_c, 0) - {prev} AS DOUBLE) / NULLIF(CAST({prev} AS DOUBLE), 0)"

    label = "printf('%.1f%%', round_even(revenue_yoy_pct * 100, 1))"
    return with_binding(f"""
SELECT *, CASE WHEN revenue_yoy_pct IS NULL THEN '' WHEN revenue_yoy_pct > 0 THEN '▲ ' || {label}
               WHEN revenue_yoy_pct < 0 THEN '▼ ' || {label} ELSE '– 0.0%' END AS revenue_yoy_arrow
FROM (SELECT {keys}, first_day, CAST(cur_c AS DOUBLE) / 100 AS revenue, CAST(ytd_c AS DOUBLE) / 100 AS revenue_ytd,
             CAST(py_c AS DOUBLE) / 100 AS revenue_py, {change('py_c')} AS revenue_yoy_pct,
             CAST(pm_c AS DOUBLE) / 100 AS revenue_pm, {change('pm_c')} AS revenue_mom_pct,
             CAST(r3_c AS DOUBLE) / 100 / NULLIF(CAST(r3_n AS DOUBLE), 0) AS revenue_3m_avg
      FROM q_wide) t""", _spans_ctes(grain, by, year_start_month))


FISCAL_YEAR_TO_DATE = with_binding("""
SELECT year_month, first_day, CAST(cur_c AS DOUBLE) / 100 AS revenue, CAST(ytd_c AS DOUBLE) / 100 AS revenue_fytd FROM q_wide
""", _spans_ctes("month", (), 7))


def many_contexts_sql(contexts, measures) -> str:
    keys = list(dict.fromkeys(k for c in contexts for k in c))
    parts = []
    for c in contexts:
        group = f" GROUP BY {', '.join(c)}" if c else ""
        sold = ", ".join(f"{sql} AS {name}" for name, sql in _AGGS["q_sales"])
        every = ", ".join(f"{sql} AS {name}" for name, sql in _AGGS["q_lines_all"])
        same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM s.{k}" for k in c) or "true"
        own = "".join(f"{k}, " for k in c)
        parts.append(f"SELECT '{','.join(c)}' AS context, {', '.join(('a.' + k) if k in c else f'CAST(NULL AS VARCHAR) AS {k}' for k in keys)}, "
                     f"s.* EXCLUDE ({', '.join(c) or 'one'}), a.returned_orders, a._orders_all, a.delivered_revenue "
                     f"FROM (SELECT {own or '1 AS one, '}{every} FROM q_lines_all{group}) a "
                     f"LEFT JOIN (SELECT {own or '1 AS one, '}{sold} FROM q_sales{group}) s ON {same}")
    final = [f"{_DERIVED[n]} AS {n}" if n in _DERIVED else n for n in measures]
    return with_binding(f"SELECT context, {', '.join(keys)}, {', '.join(final)} FROM ({' UNION ALL '.join(parts)}) p", _FAMILIES)


def order_counts_sql(keys) -> str:
    flags = ", ".join(f"CAST(grouping({k}) AS INTEGER) AS all_{k}" for k in keys)
    return with_binding(f"""
SELECT {', '.join(keys)}, {flags}, count(DISTINCT order_id) AS orders,
       count(DISTINCT CASE WHEN status = 'Delivered' THEN order_id END) AS delivered_orders,
       count(DISTINCT CASE WHEN status = 'Returned' THEN order_id END) AS returned_orders
FROM q_lines_all GROUP BY CUBE ({', '.join(keys)})""", _FAMILIES)
