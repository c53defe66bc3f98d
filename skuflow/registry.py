"""Name -> operator registry (S9) and name -> oracle SQL.

Each registered callable takes ``(spark, sf_dir)``, derives the model from the
source tables in ``sf_dir`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skuflow.operators import abc, deadstock, detail, kpis, profile, quality, questions, scorecard, turnover
from skuflow.oracle import analysis as a_sql
from skuflow.oracle import star as star_sql
from skuflow.oracle import measures as m_sql
from skuflow.oracle import feeds as b_sql
from skuflow.oracle import kpis as k_sql
from skuflow.oracle import profile as r_sql
from skuflow.oracle import quality as dq_sql
from skuflow.oracle import loads as load_sql
from skuflow.plans import contexts, feeds, loads, measures, periods, publish, star, timeintel
from skuflow.oracle import questions as q_sql
from skuflow.sources import sinks
from skuflow.sources.tpch import bind, read_sources

QueryFn = Callable[[SparkSession, str], DataFrame]


#: Time intelligence at other grains than the month: key -> grain, context.
PERIOD_VIEWS = {
    "time_intelligence_by_day": ("day", ()),
    "time_intelligence_by_quarter": ("quarter", ()),
    "time_intelligence_by_fiscal_year": ("fiscal_year", ()),
    "time_intelligence_by_day_and_warehouse": ("day", ("warehouse_name",)),
    "time_intelligence_by_quarter_and_category": ("quarter", ("category",)),
}


def _on_model(fn, **params) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bind(spark, sf_dir), **params)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _row_counts_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = bind(spark, sf_dir)
    src = read_sources(spark, sf_dir)
    return quality.row_count_checks(m, quality.expected_counts_from_sources(m, src))


def _generation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = bind(spark, sf_dir)
    src = read_sources(spark, sf_dir)
    return quality.generation_report(m, quality.expected_counts_from_sources(m, src))


def _labels(m):
    return quality.label_checks(star.dim_product(m), star.dim_supplier(m))


def queries() -> dict[str, QueryFn]:
    return {
        "row_counts": _on_model(sinks.row_counts),
        "sales_detail": _on_model(detail.sales_detail),
        "inventory_detail": _on_model(detail.inventory_detail),
        "warehouse_performance": _on_model(questions.warehouse_performance),
        "top_revenue_products": _on_model(questions.top_revenue_products),
        "stockout_risk": _on_model(questions.stockout_risk),
        "supplier_reliability": _on_model(questions.supplier_reliability),
        "dead_stock_value": _on_model(questions.dead_stock_value),
        "reorder_recommendations": _on_model(questions.reorder_recommendations),
        "abc_classification": _on_model(abc.classify_abc),
        "abc_summary": _on_model(abc.abc_summary),
        "inventory_turnover": _on_model(turnover.inventory_turnover),
        "supplier_scorecard": _on_model(scorecard.supplier_scorecard),
        "scorecard_audit": _on_model(scorecard.scorecard_audit),
        "dead_stock_detail": _on_model(deadstock.dead_stock_detail),
        "dead_stock_summary": _on_model(deadstock.dead_stock_summary),
        "dead_stock_by_category": _on_model(deadstock.dead_stock_by_category),
        "dim_date": _on_model(star.dim_date),
        "dim_product": _on_model(star.dim_product),
        "dim_supplier": _on_model(star.dim_supplier),
        "dim_warehouse": _on_model(star.dim_warehouse),
        "fact_sales": _on_model(star.fact_sales),
        "fact_inventory": _on_model(star.fact_inventory),
        "fact_purchase_orders": _on_model(star.fact_purchase_orders),
        "star_checks": _on_model(star.validated_checks),
        "star_verdict": _on_model(lambda m: star.verdict(star.validated_checks(m))),
        "dim_date_gaps": _on_model(lambda m: star.date_gaps(star.dim_date(m))),
        "risk_tier_counts": _on_model(scorecard.risk_tier_counts),
        "dq_generation_report": _generation_report,
        "dq_generation_verdict": lambda spark, sf_dir: quality.verdict(_generation_report(spark, sf_dir)),
        **{name: _on_model(measures.measure_view, name=name) for name in measures.MEASURE_VIEWS},
        "class_a_share_by_category": _on_model(measures.class_a_share, by=["category"]),
        "class_a_share_by_warehouse": _on_model(measures.class_a_share, by=["warehouse_name"]),
        "revenue_time_intelligence": _on_model(timeintel.revenue_time_intelligence),
        "dq_pk": _on_model(quality.pk_checks),
        "dq_not_null": _on_model(quality.not_null_checks),
        "dq_check": _on_model(quality.check_constraints),
        "dq_domain": _on_model(quality.domain_checks),
        "dq_fk": _on_model(quality.fk_checks),
        "dq_fk_violations": _on_model(quality.fk_violation_sample),
        "dq_row_counts": _row_counts_check,
        "dq_dates_window": _on_model(quality.date_window_check),
        "dq_on_time_share": _on_model(quality.on_time_share),
        "dq_stockout_share": _on_model(quality.stockout_share),
        "dq_dead_share": _on_model(quality.dead_share),
        "dq_top20_share": _on_model(quality.top20_share),
        "dq_po_dates": _on_model(quality.po_date_check),
        "dq_basket_stability": _on_model(quality.basket_stability),
        "dq_month_basket_corr": _on_model(quality.month_basket_corr),
        "dq_revenue_reconcile": _on_model(quality.revenue_reconcile),
        "dq_dead_reconcile": _on_model(quality.dead_reconcile),
        "dq_labels": _on_model(_labels),
        "stock_thresholds": _on_model(profile.stock_thresholds),
        "demand_percentile": _on_model(profile.demand_percentile),
        "seasonal_index": _on_model(profile.seasonal_index),
        "order_mix_profile": _on_model(profile.order_mix_profile),
        "headline_kpis": _on_model(kpis.headline_kpis),
        "monthly_revenue": _on_model(kpis.monthly_revenue),
        "monthly_revenue_pivot": _on_model(kpis.monthly_revenue_pivot),
        "warehouse_scale_quality": _on_model(kpis.warehouse_scale_quality),
        "query_headlines": _on_model(kpis.query_headlines),
        "report_facts": _on_model(kpis.report_facts),
        "feed_exec_kpis": _on_model(feeds.feed_exec_kpis),
        "feed_revenue_by_category": _on_model(feeds.feed_revenue_by_category),
        "feed_warehouse_matrix": _on_model(feeds.feed_warehouse_matrix),
        "feed_inventory_by_class": _on_model(feeds.feed_inventory_by_class),
        "feed_turnover_vs_value": _on_model(feeds.feed_turnover_vs_value),
        "feed_below_reorder": _on_model(feeds.feed_below_reorder),
        "feed_late_rate_monthly": _on_model(feeds.feed_late_rate_monthly),
        "pareto_curve": _on_model(feeds.pareto_curve),
        "pareto_crossing": _on_model(feeds.pareto_crossing),
        "stock_health_mix": _on_model(feeds.stock_health_mix),
        "dashboard_top_products": _on_model(feeds.dashboard_top_products),
        "dashboard_bottom_suppliers": _on_model(feeds.dashboard_bottom_suppliers),
        **{name: _on_model(periods.period_measures, grain=grain, by=by) for name, (grain, by) in PERIOD_VIEWS.items()},
        "line_measures_many_contexts": _on_model(contexts.standard_line_measures),
        "order_counts_all_subtotals": _on_model(contexts.order_counts, keys=("warehouse_name", "category")),
        "report_money_labels": _on_model(kpis.report_money_labels),
        "line_revenue_quantiles": _on_model(profile.line_revenue_quantiles),
        "load_rejects": _on_model(loads.load_report),
        "star_publication": _on_model(publish.publication_audit),
        "star_publication_csv": _on_model(publish.publication_audit, fmt="csv"),
        "fiscal_year_to_date": _on_model(periods.fiscal_year_to_date),
        "revenue_time_intelligence_by_warehouse": _on_model(timeintel.revenue_time_intelligence,
                                                            by=["warehouse_name"]),
    }


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's count_if is BIGINT.  Rewrite
    ``count_if(x)`` as ``count(CASE WHEN (x) THEN 1 END)`` (same NULL rule, BIGINT)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _bigint_counts(sql[j + len(key):k - 1])
        out.append(sql[i:j] + f"count(CASE WHEN ({inner}) THEN 1 END)")
        i = k


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(q_sql.SQL)
    out.update(a_sql.SQL)
    out.update(star_sql.SQL)
    out.update(dq_sql.SQL)
    out.update(r_sql.SQL)
    out.update(k_sql.SQL)
    out.update(b_sql.SQL)
    out.update(load_sql.SQL)
    for name, (families, by) in measures.MEASURE_VIEWS.items():
        out[name] = m_sql.view_sql(families, measures.view_measures(families), by)
    out["class_a_share_by_category"] = m_sql.class_a_share_sql(["category"], True)
    out["class_a_share_by_warehouse"] = m_sql.class_a_share_sql(["warehouse_name"], False)
    out["revenue_time_intelligence"] = m_sql.time_intelligence_sql([])
    out["revenue_time_intelligence_by_warehouse"] = m_sql.time_intelligence_sql(["warehouse_name"])
    out["line_measures_many_contexts"] = m_sql.many_contexts_sql(contexts.STANDARD, contexts.LINE_MEASURES)
    out["order_counts_all_subtotals"] = m_sql.order_counts_sql(("warehouse_name", "category"))
    for name, (grain, by) in PERIOD_VIEWS.items():
        out[name] = m_sql.period_sql(grain, by)
    out["fiscal_year_to_date"] = m_sql.FISCAL_YEAR_TO_DATE
    out = {k: _bigint_counts(v) for k, v in out.items()}
    return out
