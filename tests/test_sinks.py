"""Sources and sinks: CSV with declared schema, Parquet round trip, result/star/JSON sinks."""

import json

import pytest
from pyspark.sql import functions as F

from skuflow.functions.exprs import money_axis_label, money_label
from skuflow.operators import quality, questions
from skuflow.plans import feeds, star
from skuflow.sources import sinks
from skuflow.sources.model import Model
from skuflow.sources.schemas import MODEL_SCHEMAS


def _counts(m):
    return {n: df.count() for n, df in m.tables().items()}


def test_csv_round_trip_keeps_declared_schema(spark, model, tmp_path):
    model.write_csv(str(tmp_path / "csv"))
    back = Model.read_csv(spark, str(tmp_path / "csv"))
    assert _counts(back) == _counts(model)
    for name, schema in MODEL_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in back.table(name).schema.fields] == \
               [(f.name, f.dataType) for f in schema.fields]
    # same answers from the CSV-loaded model
    a = questions.warehouse_performance(model).collect()
    b = questions.warehouse_performance(back).collect()
    assert a == b


def test_dollar_csv_gives_the_same_model_and_rejects_orphans(spark, model, tmp_path):
    from skuflow.sources.load import load_csv
    from skuflow.sources.schemas import DOLLAR_COLUMNS
    out = tmp_path / "dollars"
    for name, df in model.tables().items():
        cols = [(F.col(f.name).cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias(DOLLAR_COLUMNS[f.name])
                if f.name in DOLLAR_COLUMNS else F.col(f.name) for f in MODEL_SCHEMAS[name].fields]
        df.select(*cols).write.option("header", True).csv(str(out / f"{name}.csv"))
    back = load_csv(spark, str(out))
    for c in (questions.warehouse_performance, questions.top_revenue_products, questions.dead_stock_value):
        assert c(back).collect() == c(model).collect()
    lost = model.products.orderBy("product_id").first()["product_id"]
    broken = model.replace(products=model.products.where(F.col("product_id") != lost))
    with pytest.raises(ValueError, match=f"inventory.product_id = {lost}"):
        quality.assert_references(broken)


def test_csv_failfast_rejects_bad_rows(spark, tmp_path):
    p = tmp_path / "bad"
    p.mkdir()
    (p / "warehouses.csv").write_text("warehouse_id,name,region,capacity_units\n1,A,R,not_a_number\n")
    df = (spark.read.schema(MODEL_SCHEMAS["warehouses"]).option("header", True)
          .option("mode", "FAILFAST").csv(str(p / "warehouses.csv")))
    with pytest.raises(Exception):
        df.collect()


def test_parquet_round_trip_is_idempotent(spark, model, tmp_path):
    out = str(tmp_path / "pq")
    model.write_parquet(out)
    model.write_parquet(out)                 # full rebuild: overwrite, not append
    back = Model.read_parquet(spark, out)
    assert _counts(back) == _counts(model)


def test_row_counts_and_result_sink(spark, model, tmp_path):
    rc = {r["table_name"]: r["row_count"] for r in sinks.row_counts(model).collect()}
    assert rc["orders"] == 1500 and rc["order_lines"] == 6000
    paths = sinks.write_results({"wh": questions.warehouse_performance(model)}, str(tmp_path / "res"))
    assert spark.read.option("header", True).csv(paths[0]).count() == 5


FEEDS = {"below_reorder": (feeds.feed_below_reorder, ["quantity_on_hand", "product_id", "warehouse_id"]),
         "top": (feeds.dashboard_top_products, ["rank"]), "mix": (feeds.stock_health_mix, ["display_order"])}


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_feeds_are_ordered_over_several_files(spark, model, tmp_path, many_tasks):
    given = {name: (make(model), order) for name, (make, order) in FEEDS.items()}
    index = sinks.write_feeds(given, str(tmp_path)).collect()
    for name, (df, order) in given.items():
        files = sorted((r for r in index if r["feed"] == name), key=lambda r: r["begins"])
        assert [r["file"] for r in files] == sorted(r["file"] for r in files)
        lines = []
        for r in files:
            own = (tmp_path / name / r["file"]).read_text().splitlines()
            assert len(own) == r["rows"] and len(lines) == r["begins"]
            lines += own
        wanted = [x.asDict() for x in df.orderBy(*order).collect()]
        assert [json.loads(x) for x in lines] == [{k: v for k, v in w.items() if v is not None} for w in wanted]
    assert sum(r["feed"] == "below_reorder" for r in index) > 1
    plan = given["below_reorder"][0]._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_payload_is_one_json_document(spark, model, tmp_path, many_tasks):
    given = {name: (make(model), order) for name, (make, order) in FEEDS.items()} | {"none": (model.warehouses.limit(0), ["warehouse_id"])}
    sinks.write_payload(given, str(tmp_path / "p"))
    parts = sorted((tmp_path / "p").glob("part-*"))
    got = json.loads("".join(p.read_text() for p in parts))
    assert list(got) == list(given) and len(parts) > 1
    for name, (df, order) in given.items():
        assert got[name] == [json.loads(x) for x in df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0]]


def test_money_labels(spark):
    df = spark.createDataFrame([(1234567.0,), (4321.0,), (900.0,), (0.5,), (-2500000.0,), (-4321.0,), (1.5e9,), (None,)], "x double")
    got = [tuple(r) for r in df.select(money_label(F.col("x")), money_axis_label(F.col("x"))).collect()]
    assert got == [("$1.2M", "$1.2M"), ("$4,321", "$4K"), ("$900", "$900"), ("$0", "$0"), ("$-2.5M", "$-2.5M"), ("$-4,321", "$-4K"),
                   ("$1,500.0M", "$1500.0M"), (None, None)]


def test_sql_over_registered_views(spark, model):
    """S3: the model as temp views; SQL text gives the same answer as the DataFrame operator."""
    model.register_views(prefix="m_")
    sql = spark.sql("""
        SELECT p.category, count(*) AS dead_stock_positions, sum(i.quantity_on_hand) AS total_units_tied_up
        FROM m_inventory i JOIN m_products p ON p.product_id = i.product_id
        WHERE i.quantity_on_hand >= p.safety_stock * 4
        GROUP BY p.category""")
    df = questions.dead_stock_value(model).select("category", "dead_stock_positions", "total_units_tied_up")
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, df.collect()))
