"""The multi-range running sum equals the single-window one (exact, any cut)."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.functions.exprs import pearson
from skuflow.operators import profile, scorecard
from skuflow.operators.prefix import running_totals, tied_ranks
from skuflow.operators.selection import exact_quantiles, kth_least


def test_ranges_match_single_window(spark):
    df = spark.range(0, 5000).select(
        F.col("id").alias("pid"),
        ((F.col("id") * 7919) % 613).cast("decimal(38,0)").alias("rev"))   # many ties in rev
    keys = [("rev", True), ("pid", False)]
    fast = running_totals(df, keys, "rev", ranges=8,
                          total_col="tot", count_col="n")
    w = Window.orderBy(F.desc("rev"), "pid")
    ref = df.select("pid", F.row_number().over(w).alias("rank"),
                    F.sum("rev").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_value"))
    a = fast.select("pid", "rank", "cum_value")
    assert a.exceptAll(ref).count() == 0 and ref.exceptAll(a).count() == 0
    assert fast.select("tot", "n").distinct().collect()[0] == (df.agg(F.sum("rev")).first()[0], 5000)


def test_ties_over_many_ranges(spark):
    """Half of all rows share one value, some are NULL; eight ranges cut them anywhere."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 41).cast("int").alias("v"), F.lit("x").alias("more"))
    got = tied_ranks(df, "v", ["id"], ranges=8)
    assert got.columns == ["id", "v", "more", "fewer", "ties", "n"]
    w = Window.orderBy(F.col("v").asc_nulls_first())
    ref = df.select("id", "v", "more", (F.rank().over(w) - 1).cast("long"), F.count(F.lit(1)).over(Window.partitionBy("v")), F.lit(4000).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    for constant in (df.withColumn("v", F.lit(3)), df.withColumn("v", F.lit(None).cast("int"))):
        assert set(tied_ranks(constant, "v", ["id"], ranges=8).select("fewer", "ties", "n").distinct().collect()) == {(0, 4000, 4000)}
    assert tied_ranks(df.limit(0), "v", ["id"]).count() == 0


def test_percentile_does_not_depend_on_the_ranges(model):
    one = sorted(map(tuple, profile.demand_percentile(model, ranges=1).collect()))
    assert one == sorted(map(tuple, profile.demand_percentile(model, ranges=8).collect()))


def test_correlation_bits_under_three_partitionings(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 1013 - 400).alias("x"), (F.col("id") * 104729 % 977 * 1000003).alias("y"))
    bits = {df.repartition(n).agg(pearson(F.col("x"), F.col("y"))).first()[0].hex() for n in (1, 5, 16)}
    assert len(bits) == 1
    x, y = zip(*df.collect())
    assert float.fromhex(bits.pop()) == pytest.approx(statistics.correlation(x, y), abs=1e-12)
    assert df.agg(pearson(F.col("x"), F.lit(3))).first()[0] is None
    assert df.agg(pearson(F.when(F.col("x") > 0, F.col("x")), F.col("x"))).first()[0] == pytest.approx(1.0)
    assert df.limit(0).agg(pearson(F.col("x"), F.col("y"))).first()[0] is None


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_exact_selection(spark, buckets):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") * F.col("id") * 37 % 10007 - 5000).alias("v")).repartition(4)
    values = sorted(r[0] for r in df.collect() if r[0] is not None)
    ranks = [0, 1, 100, len(values) // 2, len(values) - 1]
    assert kth_least(df, "v", ranks, buckets) == [values[k] for k in ranks]
    extremes = spark.createDataFrame([(-(1 << 63),), ((1 << 63) - 1,), (0,)], "v bigint")
    assert kth_least(extremes, "v", [0, 1, 2], buckets) == [-(1 << 63), 0, (1 << 63) - 1]


def test_quantiles_of_numbers_and_dates(spark):
    df = spark.createDataFrame([(v, dt.date(2024, 1, v)) for v in (1, 2, 4, 9)], "v int, d date")
    rows = {r["share"]: r for r in exact_quantiles(df, "v", [0.5, 0.25, 1.0]).collect()}
    assert (rows[0.5]["lower"], rows[0.5]["upper"], rows[0.5]["value"]) == (2, 4, 3.0)
    assert rows[0.25]["value"] == 1.75 and rows[1.0]["value"] == 9.0
    day = exact_quantiles(df, "d", [0.5]).first()
    assert (day["lower"], day["upper"]) == (dt.date(2024, 1, 2), dt.date(2024, 1, 4))
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(df.withColumn("x", F.lit(1.5)), "x", [0.5])


def test_purchase_orders_are_aggregated_once_for_the_scorecard(model):
    scorecard.supplier_stats(model)
    plan = scorecard.supplier_scorecard(model)._jdf.queryExecution().executedPlan().toString()
    assert "actual_delivery_date" not in plan
