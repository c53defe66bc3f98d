"""Time intelligence at any date grain: shifted periods, month ends of 28 to 31 days, leap years, fiscal years."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuflow.plans import measures, periods, timeintel
from tests.frames import WAREHOUSES, D, make_model, product, supplier


def back(day, months):
    """``months`` earlier, clamped to the month's end (plain Python)."""
    y, mth = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = (dt.date(y + (mth == 11), (mth + 1) % 12 + 1, 1) - dt.timedelta(1)).day
    return dt.date(y, mth + 1, min(day.day, last))


def month_end(day):
    return (day + dt.timedelta(1)).day == 1


def spans(first, last, start_month):
    def moved(k):
        hi = back(last, k)
        if month_end(last) and first <= last.replace(day=1):
            while not month_end(hi):
                hi += dt.timedelta(1)
        return back(first, k), hi
    year = last.year - (last.month < start_month)
    trailing = back(last.replace(day=1), 2) if month_end(last) else back(last, 3) + dt.timedelta(1)
    return {"cur": (first, last), "ytd": (D(year, start_month, 1), last), "py": moved(12), "pm": moved(1), "r3": (trailing, last)}


@pytest.fixture(scope="module")
def sold(spark):
    """Sales on most days of 2023 to early 2025 (a leap year within), one line a day, in two warehouses."""
    days = [D(2023, 1, 1) + dt.timedelta(i) for i in range(820) if i % 7 != 3]
    orders = [(i + 1, d, 1 + i % 2, 7, "Delivered" if i % 11 else "Returned") for i, d in enumerate(days)]
    lines = [(i + 1, i + 1, 1 + i % 3, 1 + i % 4, 100 + 13 * i) for i in range(len(days))]
    return make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=[product(k, cat="ab"[k % 2]) for k in (1, 2, 3)],
                      orders=orders, order_lines=lines)


@pytest.fixture(scope="module")
def daily(sold):
    out = {}
    for r in sold.facts.where("status = 'Delivered'").join(sold.warehouses, "warehouse_id").select("order_date", "name", F.expr("quantity * price_cents").alias("c")).collect():
        for key in (None, r["name"]):
            out.setdefault(key, {}).setdefault(r["order_date"], 0)
            out[key][r["order_date"]] += r["c"]
    return out


@pytest.mark.parametrize("grain", sorted(periods.GRAINS))
@pytest.mark.parametrize("start_month", [1, 7])
def test_every_span_of_every_period(sold, daily, grain, start_month):
    calendar = {r["first_day"]: r["last_day"] for r in periods.periods(sold, grain).collect()}
    assert min(calendar) == D(2023, 1, 1) and max(calendar.values()) == D(2025, 12, 31)
    for by in ([], ["warehouse_name"]):
        rows = periods.period_measures(sold, grain, by, start_month).collect()
        assert len(rows) == len(calendar) * (2 if by else 1)
        for r in rows:
            days = daily[r["warehouse_name"] if by else None]
            got = {"cur": "revenue", "ytd": "revenue_ytd", "py": "revenue_py", "pm": "revenue_pm", "r3": "revenue_3m_avg"}
            for name, (lo, hi) in spans(r["first_day"], calendar[r["first_day"]], start_month).items():
                own = [c for d, c in days.items() if lo <= d <= hi]
                want = sum(own) / 100 if own else None
                if name == "r3" and own:
                    want = sum(own) / 100 / len(own)
                assert r[got[name]] == want, (grain, name, r["first_day"])


def test_shifts_at_month_ends(spark):
    ends = [(D(2023, 2, 1), D(2023, 2, 28)), (D(2023, 2, 28), D(2023, 2, 28)), (D(2024, 2, 29), D(2024, 2, 29)), (D(2024, 2, 1), D(2024, 2, 29)),
            (D(2023, 3, 31), D(2023, 3, 31)), (D(2023, 3, 30), D(2023, 3, 30)), (D(2023, 4, 1), D(2023, 6, 30)), (D(2022, 7, 1), D(2023, 6, 30)), (D(2023, 5, 30), D(2023, 5, 30))]
    calendar = spark.createDataFrame(ends, "first_day date, last_day date")
    got = {(r["first_day"], r["last_day"], r["span"]): (r["lo"], r["hi"]) for r in periods.shifted_periods(calendar, 7).collect()}
    assert got == {(a, b, name): v for a, b in ends for name, v in spans(a, b, 7).items()}
    assert got[D(2023, 2, 1), D(2023, 2, 28), "pm"] == (D(2023, 1, 1), D(2023, 1, 31))
    assert got[D(2023, 2, 28), D(2023, 2, 28), "pm"] == (D(2023, 1, 28), D(2023, 1, 28))
    assert got[D(2023, 3, 31), D(2023, 3, 31), "pm"] == (D(2023, 2, 28), D(2023, 2, 28))
    assert got[D(2024, 2, 29), D(2024, 2, 29), "py"] == (D(2023, 2, 28), D(2023, 2, 28))
    assert got[D(2023, 2, 28), D(2023, 2, 28), "r3"] == (D(2022, 12, 1), D(2023, 2, 28))
    assert got[D(2023, 5, 30), D(2023, 5, 30), "r3"] == (D(2023, 3, 1), D(2023, 5, 30))
    assert got[D(2022, 7, 1), D(2023, 6, 30), "ytd"] == (D(2022, 7, 1), D(2023, 6, 30))


def test_months_equal_the_month_recipe(model):
    cols = ["year_month", "revenue", "revenue_ytd", "revenue_py", "revenue_yoy_pct", "revenue_pm", "revenue_mom_pct", "revenue_3m_avg", "revenue_yoy_arrow"]
    spine = timeintel.revenue_time_intelligence(model).select(*cols)
    months = {r["year_month"]: r for r in periods.period_measures(model, "month").select(*cols).collect()}
    rows = spine.collect()
    assert rows and all(months[r["year_month"]] == r for r in rows)


def test_only_contiguous_periods_and_sales_dimensions(model):
    with pytest.raises(ValueError, match="grain"):
        periods.period_measures(model, "weekday")
    with pytest.raises(ValueError, match="split"):
        periods.period_measures(model, "day", ["year"])
    with pytest.raises(ValueError, match="split"):
        periods.period_measures(model, "day", ["risk_tier"])


@pytest.fixture(scope="module")
def broken(spark):
    """Lines of an unknown product, orders of an unknown warehouse, positions and purchases without their dimension rows."""
    orders = [(i, D(2024, 1, 1 + i), 9 if i % 5 == 0 else 1 + i % 2, 7, "Delivered" if i % 3 else "Returned") for i in range(1, 25)]
    lines = [(i, i, 77 if i % 4 == 0 else 1 + i % 2, 2, 100 * i) for i in range(1, 25)]
    return make_model(spark, warehouses=WAREHOUSES, suppliers=[supplier(1)], products=[product(1, "a"), product(2, "b")], orders=orders, order_lines=lines,
                      inventory=[(1, 1, 5, D(2024, 1, 1)), (2, 77, 9, D(2024, 1, 1)), (9, 2, 4, D(2024, 1, 1))],
                      purchase_orders=[(i, 8 if i % 3 == 0 else 1, 77 if i % 4 == 0 else 2, D(2024, 1, 2), D(2024, 1, 9), D(2024, 1, 11) if i % 2 else None, 5) for i in range(1, 13)])


ADDITIVE = {"lines": ["total_revenue", "total_margin", "total_cogs", "total_units_sold", "delivered_revenue"], "inventory": ["inventory_value", "units_on_hand", "skus_below_reorder_point"],
            "purchase_orders": ["purchase_order_count", "delivered_pos", "late_pos"]}


@pytest.mark.parametrize("family, by", [
    ("lines", ["category"]), ("lines", ["warehouse_name"]), ("lines", ["sku"]), ("lines", ["abc_class"]), ("lines", ["category", "warehouse_region"]), ("lines", ["year_month"]),
    ("lines", ["product_id"]), ("inventory", ["category"]), ("inventory", ["warehouse_name"]), ("inventory", ["abc_class", "warehouse_id"]),
    ("purchase_orders", ["supplier_name"]), ("purchase_orders", ["category"]), ("purchase_orders", ["risk_tier"])])
def test_contexts_add_up_to_the_total(broken, family, by):
    names = ADDITIVE[family]
    total = measures.evaluate(broken, names).first()
    rows = measures.evaluate(broken, names, by).collect()
    for n in names:
        assert sum(r[n] or 0 for r in rows) == pytest.approx(total[n]), n
    if by not in (["year_month"],):
        assert all(any(r[k] is None for r in rows) for k in by)            # the blank members


def test_class_a_share_of_the_blank_member(broken):
    rows = measures.class_a_share(broken, ["warehouse_name"]).collect()
    assert {r["warehouse_name"] for r in rows} == {"North", "South", None}
    total = measures.evaluate(broken, ["total_revenue"]).first()[0]
    assert sum(r["total_revenue"] for r in rows) == pytest.approx(total)
    for r in rows:
        assert (r["class_a_revenue_pct"] is None) == (r["class_a_revenue"] is None)


def test_time_intelligence_keeps_orphan_sales(broken):
    by_cat = periods.period_measures(broken, "year", ["category"]).collect()
    total = periods.period_measures(broken, "year").first()["revenue"]
    assert sum(r["revenue"] or 0 for r in by_cat) == pytest.approx(total)
    assert None in {r["category"] for r in by_cat}
