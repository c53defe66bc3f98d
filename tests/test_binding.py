"""FIXTURES.md part C anchors at sf0.001, on the loaded and the lazy model."""

import pytest
from pyspark.sql import functions as F

from skuflow.operators import abc, deadstock, questions, scorecard
from tests.conftest import SF001


@pytest.fixture(params=["model", "lazy_model"])
def m(request):
    return request.getfixturevalue(request.param)


def test_row_counts(m):
    counts = [m.orders.count(), m.order_lines.count(), m.products.count(), m.inventory.count(),
              m.purchase_orders.count()]
    assert counts == [1500, 6000, 200, 1000, 6000]
    assert m.purchase_orders.filter(F.col("actual_delivery_date").isNull()).count() == 319


def test_money_and_thresholds(m):
    rev = m.order_lines.agg(F.sum(F.col("quantity") * F.col("price_cents"))).first()[0]
    assert rev == 30127008274
    margin = (m.order_lines.join(m.products, "product_id")
              .agg(F.sum(F.col("quantity") * (F.col("price_cents") - F.col("unit_cost_cents")))).first()[0])
    assert margin == 20015152177
    ss, rp = m.products.agg(F.sum("safety_stock"), F.sum("reorder_point")).first()
    assert (ss, rp) == (1050, 3060)


def test_status_mix(m):
    got = {r["status"]: r["count"] for r in m.orders.groupBy("status").count().collect()}
    assert got == {"Delivered": 493, "Returned": 493, "Cancelled": 514}


def test_inventory_anchors(m):
    pos = m.inventory.join(m.products, "product_id")
    on_hand, value = pos.agg(F.sum("quantity_on_hand"),
                             F.sum(F.col("quantity_on_hand") * F.col("unit_cost_cents"))).first()
    assert (on_hand, value) == (17160, 1139251361)
    assert pos.filter(F.col("quantity_on_hand") < F.col("reorder_point")).count() == 125
    assert pos.filter(F.col("quantity_on_hand") >= F.col("safety_stock") * 4).count() == 100


def test_reorder_recommendation_totals(m):
    # C6 before its LIMIT: sum over every below-reorder position
    full = questions.reorder_recommendations(m, limit=10 ** 9)
    rec, units = full.agg(F.sum("recommended_order_quantity"), F.sum("units_sold_last_30_days")).first()
    assert (rec, units) == (510, 421)


@pytest.mark.parametrize("window, expected", [(90, (817, 18, 4, 161)), (720, (525, 341, 2, 132))])
def test_dead_stock_status_counts(m, window, expected):
    d = deadstock.dead_stock_cents(m, window)
    got = {r["stock_status"]: r["count"] for r in d.groupBy("stock_status").count().collect()}
    assert tuple(got.get(s, 0) for s in ("Dead", "Slow-Moving", "Overstocked", "Healthy")) == expected


def test_po_lateness(m):
    delivered = m.purchase_orders.filter(F.col("actual_delivery_date").isNotNull())
    late = delivered.filter(F.col("actual_delivery_date") > F.col("expected_delivery_date")).count()
    assert (late, delivered.count()) == (658, 5681)


def test_scorecard_tiers(m):
    got = {r["risk_tier"]: r["count"] for r in scorecard.supplier_scorecard(m).groupBy("risk_tier").count().collect()}
    assert (got.get("Preferred", 0), got.get("Monitor", 0), got.get("High Risk", 0)) == (8, 0, 2)


def test_abc_classes(m):
    c = abc.classify_cents(m)
    rows = {r["abc_class"]: (r["n"], r["rev"]) for r in
            c.groupBy("abc_class").agg(F.count(F.lit(1)).alias("n"), F.sum("revenue_cents").alias("rev")).collect()}
    assert rows == {"A": (134, 7984472343), "B": (44, 1528432542), "C": (22, 504471354)}


def test_warehouse_performance_shape(m):
    r = questions.warehouse_performance(m)
    assert r.columns == ["warehouse_id", "warehouse_name", "region", "total_orders", "total_revenue",
                         "avg_order_value", "return_rate_pct", "cancellation_rate_pct"]
    assert r.count() == 5


def test_rewritten_sources_are_noticed(spark, tmp_path):
    import shutil

    from skuflow.sources import tpch
    folder = tmp_path / "tables"
    folder.mkdir()
    for t in tpch.SOURCE_TABLES:
        shutil.copy(f"{SF001}/{t}.parquet", folder / f"{t}.parquet")
    first = tpch.bind(spark, str(folder), materialize=False)
    assert tpch.bind(spark, str(folder), materialize=False) is first
    spark.read.parquet(f"{SF001}/region.parquet").where("r_regionkey < 3").write.parquet(str(tmp_path / "region"))
    (folder / "region.parquet").unlink()
    shutil.copytree(tmp_path / "region", folder / "region.parquet")
    again = tpch.bind(spark, str(folder), materialize=False, refresh=True)
    assert again is not first and again.warehouses.count() == 3
    calls = tpch._VERSIONS[(spark.sparkContext.applicationId, str(folder))]
    tpch.bind(spark, str(folder), materialize=False)
    assert tpch._VERSIONS[(spark.sparkContext.applicationId, str(folder))] == calls


def test_an_order_with_too_many_lines_stops(spark, monkeypatch):
    from skuflow.sources import tpch
    monkeypatch.setattr(tpch, "LINES_PER_ORDER", 4)
    lines = tpch._lines(tpch.read_sources(spark, SF001))
    with pytest.raises(Exception, match="too many lines"):
        lines.agg(F.max("line_id")).collect()
