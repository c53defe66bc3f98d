"""Boundary cases of FIXTURES.md part D on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from skuflow.operators import abc, deadstock, scorecard, turnover
from skuflow.plans import star, timeintel
from tests.frames import WAREHOUSES, D, make_model, product, supplier


def _sales(spark, revenues, date=D(2024, 1, 10)):
    """One Delivered order per product with revenue (cents) as price, quantity 1."""
    prods = [product(i + 1) for i in range(len(revenues))]
    orders = [(i + 1, date, 1, 7, "Delivered") for i in range(len(revenues))]
    lines = [(i + 1, i + 1, i + 1, 1, r) for i, r in enumerate(revenues)]
    return make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=prods,
                      orders=orders, order_lines=lines)


def _classes(m):
    return [r["abc_class"] for r in abc.classify_abc(m).orderBy("rank").collect()]


def test_abc_dominant_sku_leaves_a_empty(spark):
    # the SKU that crosses 80 % is B, so a single 85 % SKU leaves A empty
    # cumulative shares 0.85, 0.95, 1.00: the 85 % SKU crosses 0.80 so it is B
    assert _classes(_sales(spark, [8500, 1000, 500])) == ["B", "B", "C"]
    assert _classes(_sales(spark, [8500, 1100, 400])) == ["B", "C", "C"]


def test_abc_exact_boundary_is_inclusive(spark):
    # cumulative share exactly 0.80 -> A; exactly 0.95 -> B
    assert _classes(_sales(spark, [8000, 1500, 500])) == ["A", "B", "C"]


def test_abc_ties_break_on_product_id(spark):
    rows = abc.classify_abc(_sales(spark, [500, 500])).orderBy("rank").collect()
    assert [r["product_id"] for r in rows] == [1, 2]
    assert [r["cumulative_revenue_share"] for r in rows] == [0.5, 1.0]


def _po(po_id, sid, expected, delay, order=D(2024, 1, 1)):
    actual = None if delay is None else expected + dt.timedelta(days=delay)
    return (po_id, sid, 1, order, expected, actual, 10)


def test_scorecard_minimum_sample_and_all_on_time(spark):
    e = D(2024, 2, 1)
    pos = [_po(i, 1, e, 0) for i in range(1, 5)]                # 4 delivered: excluded
    pos += [_po(10 + i, 2, e, -1) for i in range(5)]            # 5 early: kept, never late
    pos += [_po(20, 2, e, None)]                                # in transit: ignored
    m = make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1), supplier(2)],
                   products=[product(1)], purchase_orders=pos)
    rows = scorecard.supplier_scorecard(m).collect()
    assert [r["supplier_id"] for r in rows] == [2]
    r = rows[0]
    assert (r["delivered_pos"], r["late_pos"], r["on_time_score"]) == (5, 0, 100.0)
    # worst delay 0 -> severity and consistency are 100 by definition
    assert (r["delay_score"], r["consistency_score"], r["composite_score"], r["risk_tier"]) == \
        (100.0, 100.0, 100.0, "Preferred")


def test_dead_stock_rounding_boundaries(spark):
    snap = D(2024, 6, 30)
    prods = [product(1, ss=100), product(2, ss=1000), product(3, ss=0), product(4, ss=10)]
    inv = [(1, 1, 200, D(2024, 1, 1)),      # ratio exactly 2.00, no sales -> Dead
           (1, 2, 1996, D(2024, 1, 1)),     # 1.996 rounds to 2.00 -> Dead
           (1, 3, 50, D(2024, 1, 1)),       # safety 0: ratio NULL -> not Dead
           (1, 4, 180, D(2024, 1, 1))]      # 90 units in 90 days -> 180.0 days: not slow
    orders = [(1, snap, 1, 1, "Delivered")]
    lines = [(1, 1, 4, 90, 100)]
    m = make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=prods,
                   inventory=inv, orders=orders, order_lines=lines)
    got = {r["product_id"]: (r["stock_ratio"], r["days_of_supply"], r["stock_status"])
           for r in deadstock.dead_stock_detail(m).collect()}
    assert got[1] == (2.0, None, "Dead")
    assert got[2] == (2.0, None, "Dead")
    assert got[3] == (None, None, "Healthy")
    assert got[4] == (18.0, 180.0, "Overstocked")


def test_turnover_one_sided_categories_and_single_day(spark):
    prods = [product(1, cat="sold_only"), product(2, cat="stock_only")]
    orders = [(1, D(2024, 3, 1), 1, 1, "Delivered")]
    lines = [(1, 1, 1, 10, 300)]
    inv = [(1, 2, 5, D(2024, 1, 1))]
    m = make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=prods,
                   inventory=inv, orders=orders, order_lines=lines)
    got = {r["category"]: r for r in turnover.inventory_turnover(m).collect()}
    assert set(got) == {"sold_only", "stock_only"}
    # single sale day: period is clamped to one day
    assert got["sold_only"]["annualized_cogs"] == 10.0 * 365
    assert got["sold_only"]["inventory_turnover"] is None          # no stock value
    assert got["stock_only"]["inventory_turnover"] == 0.0 and got["stock_only"]["days_of_supply"] is None


def test_dim_date_leap_year_and_fiscal_rollover(spark):
    d = star.dim_date_between(spark, D(2024, 2, 28), D(2024, 7, 1))
    rows = {r["date"]: r for r in d.collect()}
    assert D(2024, 2, 29) in rows and len(rows) == (D(2024, 7, 1) - D(2024, 2, 28)).days + 1
    assert rows[D(2024, 6, 30)]["fiscal_year"] == 2024 and rows[D(2024, 7, 1)]["fiscal_year"] == 2025
    assert rows[D(2024, 3, 1)]["date_key"] == 20240301
    assert rows[D(2024, 3, 2)]["day_of_week"] == 5 and rows[D(2024, 3, 2)]["is_weekend"]
    assert rows[D(2024, 3, 4)]["day_name"] == "Mon" and rows[D(2024, 3, 4)]["day_of_week"] == 0


def test_star_checks_detect_broken_key(spark):
    m = _sales(spark, [100, 200])
    s = star.build_star(m)
    broken = s.fact_sales.unionByName(s.fact_sales.limit(1).withColumn("product_id", F.lit(999).cast("long")))
    bad = star.Star(**{**s.tables(), "fact_sales": broken})
    failed = [r["check"] for r in star.star_checks(bad).filter(~F.col("passed")).collect()]
    assert failed == ["fact_sales.product_id resolves"]
    assert star.star_checks(s).filter(~F.col("passed")).count() == 0


def test_time_intelligence_missing_month_and_first_year(spark):
    prods = [product(1)]
    orders = [(1, D(2023, 1, 5), 1, 1, "Delivered"), (2, D(2023, 3, 5), 1, 1, "Delivered"),
              (3, D(2024, 1, 7), 1, 1, "Delivered"), (4, D(2024, 1, 8), 1, 1, "Delivered")]
    lines = [(i, i, 1, 1, c) for i, c in ((1, 1000), (2, 3000), (3, 500), (4, 700))]
    m = make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=prods,
                   orders=orders, order_lines=lines)
    rows = {r["year_month"]: r for r in timeintel.revenue_time_intelligence(m).collect()}
    assert len(rows) == 24                                   # dense spine over both years
    feb = rows["2023-02"]
    assert feb["revenue"] is None and feb["revenue_pm"] == 10.0 and feb["revenue_mom_pct"] == -1.0
    assert rows["2023-03"]["revenue_ytd"] == 40.0
    assert rows["2023-01"]["revenue_py"] is None and rows["2023-01"]["revenue_yoy_arrow"] == ""
    jan24 = rows["2024-01"]
    assert jan24["revenue"] == 12.0 and jan24["revenue_py"] == 10.0 and jan24["revenue_ytd"] == 12.0
    assert jan24["revenue_yoy_arrow"] == "▲ 20.0%"
    # trailing 3 months of 2023-03: revenue 40.00 over 2 days with sales
    assert rows["2023-03"]["revenue_3m_avg"] == 20.0


def test_date_gap_detected(spark):
    d = star.dim_date_between(spark, D(2024, 2, 27), D(2024, 3, 3)).filter(F.col("date") != D(2024, 2, 29))
    gaps = [(r["date"], r["gap_days"]) for r in star.date_gaps(d).collect()]
    assert gaps == [(D(2024, 3, 1), 2)]
    assert star.date_gaps(star.dim_date_between(spark, D(2024, 2, 27), D(2024, 3, 3))).count() == 0


def test_thresholds_are_arguments(spark):
    """Non-default weights, tiers, audit bands, slow days, ratios, fiscal start and quality bands."""
    from skuflow.operators import quality
    from skuflow.plans import periods

    pos = [(100 * s + i, s, 1, D(2024, 1, 1), D(2024, 1, 10), D(2024, 1, 10) + dt.timedelta(s * (i % 2)), 5) for s in (1, 2, 3) for i in range(6)]
    m = make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(s) for s in (1, 2, 3)], products=[product(1), product(2, ss=4)],
                   inventory=[(1, 1, 20, D(2024, 1, 1)), (1, 2, 9, D(2024, 1, 1)), (2, 2, 4, D(2024, 1, 1))], purchase_orders=pos,
                   orders=[(1, D(2024, 3, 5), 1, 7, "Delivered")], order_lines=[(1, 1, 2, 1, 200)])
    only = {r["supplier_id"]: r for r in scorecard.supplier_scorecard(m, weights=(1.0, 0.0, 0.0), tiers=((50, "Good"), (90, "Best")), floor="Poor").collect()}
    assert all(r["composite_score"] == r["on_time_score"] == 50.0 and r["risk_tier"] == "Good" for r in only.values())
    worst = scorecard.supplier_scorecard(m, weights=(0.0, 1.0, 0.0), tiers=((60, "Fine"),), floor="Poor").collect()
    assert [(r["supplier_id"], r["composite_score"], r["risk_tier"]) for r in worst] == [(3, 0.0, "Poor"), (2, 33.33, "Poor"), (1, 66.67, "Fine")]
    assert scorecard.scorecard_audit(m, bands=((-2.0, "any"),), floor="none").first()["interpretation"] in ("any", "none")

    status = lambda **k: {(r["warehouse_id"], r["product_id"]): r["stock_status"] for r in deadstock.dead_stock_detail(m, **k).collect()}
    assert status() == {(1, 1): "Dead", (1, 2): "Slow-Moving", (2, 2): "Healthy"}
    assert status(slow_days=10000) == {(1, 1): "Dead", (1, 2): "Healthy", (2, 2): "Healthy"}
    assert status(slow_days=10000, overstock_ratio=2.2) == {(1, 1): "Dead", (1, 2): "Overstocked", (2, 2): "Healthy"}
    assert status(dead_ratio=5) == {(1, 1): "Overstocked", (1, 2): "Slow-Moving", (2, 2): "Healthy"}
    assert {r["stock_status"] for r in deadstock.dead_stock_summary(m, dead_ratio=1).collect()} == {"Dead", "Slow-Moving"}
    assert deadstock.dead_stock_by_category(m, slow_days=10000).first()["problem_positions"] == 1

    years = {r["date"]: r["fiscal_year"] for r in star.dim_date(m, 4).collect()}
    assert (years[D(2024, 3, 31)], years[D(2024, 4, 1)]) == (2024, 2025)
    assert {r["fiscal_year"] for r in star.dim_date(m, 1).collect()} == {2024}
    spans = {(r["first_day"], r["last_day"]) for r in periods.periods(m, "fiscal_year", 4).collect()}
    assert spans == {(D(2024, 1, 1), D(2024, 3, 31)), (D(2024, 4, 1), D(2024, 12, 31))}

    assert not quality.on_time_share(m).first()["passed"] and quality.on_time_share(m, (0.4, 0.6)).first()["passed"]
    assert quality.stockout_share(m, (0.0, 1.0)).first()["passed"] and not quality.dead_share(m, (0.9, 1.0)).first()["passed"]
    assert not quality.top20_share(m, 1.5).first()["passed"]
    report = {r["check"]: r["passed"] for r in quality.generation_report(m, bands={"on_time": (0.5, 0.5)}, window=("2024-01-01", "2024-12-31")).collect()}
    assert report["on-time share of delivered purchase orders within its band"] and report["orders dated inside the expected window"]
