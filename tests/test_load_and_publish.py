"""Loads that name what they reject; a star that is published only when its files are right."""

import glob
import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skuflow.operators import questions
from skuflow.plans import loads, publish, star
from skuflow.sources import rejects
from skuflow.sources.rejects import LoadStopped, load_with_rejects
from skuflow.sources.schemas import DOLLAR_COLUMNS, LOAD_ORDER, MODEL_SCHEMAS

GOOD = {
    "warehouses": ["1,North,N,100", "2,South,S,100"],
    "suppliers": ["1,S1,N,cat,0.9,10"],
    "products": ["1,SKU-1,cat,1.00,2.00,1,10,5,", "2,SKU-2,cat,1.50,2.25,1,10,5,0.5"],
    "inventory": ["1,1,5,2024-01-01", "2,1,5,2024-01-01"],
    "purchase_orders": ["1,1,1,2024-01-01,2024-01-09,,5"],
    "orders": ["1,2024-01-03,1,7,Delivered", "2,2024-01-04,2,7,Returned"],
    "order_lines": ["1,1,1,2,1.99", "2,2,1,1,2.00"],
}


def files(folder, **more):
    for table in LOAD_ORDER:
        header = ",".join(DOLLAR_COLUMNS.get(f.name, f.name) for f in MODEL_SCHEMAS[table].fields)
        rows = [*GOOD[table], *more.get(table, [])]
        (folder / f"{table}.csv").write_text("\n".join([header, *rows]) + "\n")
    return str(folder)


BAD = {
    "products": ["3,SKU-3,cat,2.00,1.00,1,10,5,",        # price below cost
                 "4,SKU-1,cat,1.00,2.00,1,10,5,",        # sku of another row
                 "5,SKU-5,cat,1.005,2.00,1,10,5,",       # part of a cent
                 "6,SKU-6,cat,1.00,2.00,99,10,5,"],      # unknown supplier
    "orders": ["3,2024-01-03", "4,2024-13-03,1,7,Delivered", "5,2024-1-3,1,7,Delivered", "6,2024-01-03,,7,Delivered", "7,2024-01-03,9,7,Lost",
               "1,2024-01-03,1,7,Returned", "8,2024-01-03,1,7,Delivered,extra", '9,"2024-01-03,1,7,Delivered'],
    "order_lines": ["3,3,1,1,1.00", "4,1,6,0,1.00", "5,1,1,many,1.00", "2,2,1,1,2.00", "99999999999999999999,1,1,1,1.00"],
}


def test_every_bad_row_is_named(spark, tmp_path):
    (tmp_path / "in").mkdir()
    load = load_with_rejects(spark, files(tmp_path / "in", **BAD), str(tmp_path / "out"))
    got = {(r["table"], r["line"]): tuple(r["reasons"]) for r in load.rejects.collect()}
    assert got == {
        ("products", BAD["products"][0]): ("breaks unit_price >= unit_cost",),
        ("products", BAD["products"][1]): ("repeats sku",),
        ("products", BAD["products"][2]): ("unit_cost is no amount in cents",),
        ("products", BAD["products"][3]): ("supplier_id is not in suppliers",),
        ("orders", BAD["orders"][0]): ("malformed row",),
        ("orders", BAD["orders"][1]): ("order_date is no date",),
        ("orders", BAD["orders"][2]): ("order_date is no date",),
        ("orders", BAD["orders"][3]): ("warehouse_id is missing",),
        ("orders", BAD["orders"][4]): ("status is not in its domain", "warehouse_id is not in warehouses"),
        ("orders", BAD["orders"][5]): ("repeats order_id",),
        ("orders", BAD["orders"][6]): ("malformed row",),
        ("orders", BAD["orders"][7]): ("malformed row",),
        ("order_lines", BAD["order_lines"][0]): ("order_id is not in orders",),
        ("order_lines", BAD["order_lines"][1]): ("breaks quantity > 0", "product_id is not in products"),
        ("order_lines", BAD["order_lines"][2]): ("quantity is no int",),
        ("order_lines", BAD["order_lines"][3]): ("repeats order_line_id",),
        ("order_lines", BAD["order_lines"][4]): ("order_line_id is no bigint",),
    }
    assert {t: load.model.table(t).count() for t in LOAD_ORDER} == {t: len(GOOD[t]) for t in LOAD_ORDER}
    assert load.model.order_lines.orderBy("order_line_id").first()["price_cents"] == 199
    assert all("/in/" in r["file"] for r in load.rejects.select("file").collect())
    assert {(r["table"], r["reason"]): r["rows"] for r in load.counts().collect()} == Counter((t, why) for (t, _), all_ in got.items() for why in all_)
    assert questions.warehouse_performance(load.model).count() == 2


def test_a_threshold_stops_the_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = files(tmp_path / "in", **BAD)
    with pytest.raises(LoadStopped, match="17 rows rejected, 16 allowed") as e:
        load_with_rejects(spark, path, str(tmp_path / "a"), max_rejects=16)
    assert e.value.counts["orders", "malformed row"] == 3
    load_with_rejects(spark, path, str(tmp_path / "b"), max_rejects=17)
    with pytest.raises(LoadStopped):
        load_with_rejects(spark, path, str(tmp_path / "c"), max_share=0.3)
    load_with_rejects(spark, path, str(tmp_path / "d"), max_share=0.9)


def test_good_files_load_whole_and_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = files(tmp_path / "in")
    for _ in range(2):                                                   # a rerun replaces what the first one wrote
        load = load_with_rejects(spark, path, str(tmp_path / "out"), max_rejects=0)
        assert load.rejects.count() == 0 and load.model.order_lines.count() == 2


def test_wrong_columns_stop_at_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = files(tmp_path / "in")
    (tmp_path / "in" / "orders.csv").write_text("order_id,order_date\n1,2024-01-01\n")
    with pytest.raises(ValueError, match="expected"):
        load_with_rejects(spark, path, str(tmp_path / "out"))


def test_report_of_a_faulty_load(model):
    got = {(r["table"], r["outcome"]): r["rows"] for r in loads.load_report(model).collect()}
    assert got["orders", "malformed row"] == model.orders.where("order_id % 50 = 7").count()
    assert got["orders", "loaded"] == model.orders.where("order_id % 50 not in (7, 11, 13)").count()
    assert got["warehouses", "loaded"] == 5


LATE = {
    "products": ["7,SKU-7,cat,1.00,2.00,1,10,5,", "7,SKU-8,cat,1.00,2.00,1,10,5,",      # the second goes, so SKU-8 is on one row only
                 "8,SKU-8,cat,1.00,2.00,1,10,5,"],
    "order_lines": ["8,1,1,2,1.99", "8,77,1,1,1.00",                                    # an orphan repeats no key
                    "9,1,1,2,1.99", "9,1,1,2,1.99", "9,1,1,2,1.99", "9,1,1,3,1.99",     # of equal rows one stays
                    "10,78,1,0,1.00"],
}


@pytest.mark.parametrize("bits", [6, rejects.KEY_BITS])
def test_rows_are_judged_alike_however_full_the_bitmap_is(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(rejects, "KEY_BITS", bits)
    (tmp_path / "in").mkdir()
    load = load_with_rejects(spark, files(tmp_path / "in", **LATE), str(tmp_path / "out"))
    assert Counter((r["line"], tuple(r["reasons"])) for r in load.rejects.collect()) == {
        (LATE["products"][1], ("repeats product_id",)): 1,
        (LATE["order_lines"][1], ("order_id is not in orders",)): 1,
        (LATE["order_lines"][2], ("repeats order_line_id",)): 2, (LATE["order_lines"][5], ("repeats order_line_id",)): 1,
        (LATE["order_lines"][6], ("breaks quantity > 0", "order_id is not in orders")): 1,
    }
    assert all("/in/" in r["file"] for r in load.rejects.select("file").collect())
    assert sorted(r["product_id"] for r in load.model.products.collect()) == [1, 2, 7, 8]
    assert sorted(r["order_line_id"] for r in load.model.order_lines.collect()) == [1, 2, 8, 9]


def test_only_rows_of_keys_at_fault_are_moved(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, keys = spark.range(1000).withColumnRenamed("id", "k"), spark.range(3, 5).withColumnRenamed("id", "at_fault")
        marked = rejects._marked(rows, [(("k",), keys)])
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(k" not in plan
        assert {3, 4} <= {r["k"] for r in marked.where("__late").collect()} and marked.where("not __late").count() > 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_load_leaves_neither_shuffles_nor_copies_of_rows(spark, tmp_path):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in found.split("\n") if "/shuffle_" in x}

    (tmp_path / "in").mkdir()
    path, before, configured = files(tmp_path / "in", **BAD), shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    load_with_rejects(spark, path, str(tmp_path / "out"))
    until = time.time() + 20                                             # executors delete them when they are told
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == configured
    assert not any(glob.glob(f"{tmp_path}/out/keys/*"))
    rows = spark.read.parquet(*glob.glob(f"{tmp_path}/out/rows/*"))      # good rows are written once and without their text
    assert rows.count() == sum(len(GOOD[t]) + len(BAD.get(t, [])) for t in LOAD_ORDER)
    assert rows.where("__line is not null").count() == sum(map(len, BAD.values())) + 3      # three good ones have a key that another repeats


def test_faulty_files_are_packed(spark, model, tmp_path):
    loads.faulty_files(model, str(tmp_path))
    for table in ("orders", "order_lines"):
        size = sum(os.path.getsize(x) for x in glob.glob(f"{tmp_path}/{table}.csv/part-*"))
        lines = spark.read.text(f"{tmp_path}/{table}.csv")
        assert lines.count() >= model.table(table).count() and size < lines.agg(F.sum(F.length("value") + 1)).first()[0] / 2


@pytest.fixture(scope="module")
def frozen(model):
    return star.freeze_dimensions(star.build_star(model))


@pytest.mark.parametrize("fmt", publish.FORMATS)
def test_published_star_is_read_back(spark, frozen, fmt, tmp_path):
    done = publish.publish_star(frozen, str(tmp_path), fmt)
    back = publish.read_star(spark, str(tmp_path))
    audit = {r["table"]: r for r in done.audit.collect()}
    for name, df in frozen.tables().items():
        other = back.tables()[name]
        assert other.schema.simpleString() == df.schema.simpleString()
        assert audit[name]["columns"] == df.columns and audit[name]["rows"] == df.count()
        assert df.exceptAll(other).isEmpty() and other.exceptAll(df).isEmpty()
    for fact in ("fact_sales", "fact_purchase_orders"):                  # few files a month, not months times tasks
        months = glob.glob(f"{tmp_path}/versions/*/{fact}/year_month=*")
        parts = glob.glob(f"{tmp_path}/versions/*/{fact}/year_month=*/part-*")
        assert months and len(parts) <= len(months) + spark.sparkContext.defaultParallelism
    plan = back.fact_sales.where("date_key between 19950101 and 19950131")
    assert plan.count() == frozen.fact_sales.where("date_key between 19950101 and 19950131").count()


def test_failed_publication_leaves_the_old_star(spark, frozen, tmp_path):
    first = publish.publish_star(frozen, str(tmp_path))
    tables = frozen.tables()
    lost = tables["dim_warehouse"].agg(F.min("warehouse_id")).first()[0]
    broken = star.Star(**{**tables, "dim_warehouse": tables["dim_warehouse"].where(F.col("warehouse_id") != lost)})
    with pytest.raises(publish.PublicationFailed, match="warehouse_id resolves"):
        publish.publish_star(broken, str(tmp_path))
    leaking = star.Star(**{**tables, "dim_supplier": tables["dim_supplier"].withColumn("base_reliability_score", F.lit(1.0))})
    with pytest.raises(publish.PublicationFailed, match="hidden columns"):
        publish.publish_star(leaking, str(tmp_path))
    assert len(os.listdir(tmp_path / "versions")) == 3
    assert {r["version"] for r in publish.current_manifest(spark, str(tmp_path)).collect()} == {first.version}
    assert publish.read_star(spark, str(tmp_path)).dim_warehouse.count() == tables["dim_warehouse"].count()
    second = publish.publish_star(frozen, str(tmp_path), "csv")
    assert {r["version"] for r in publish.current_manifest(spark, str(tmp_path)).collect()} == {second.version}


def test_manifest_is_plain_json(frozen, tmp_path):
    done = publish.publish_star(frozen, str(tmp_path))
    lines = [json.loads(x) for f in glob.glob(f"{tmp_path}/manifests/{done.version}/part-*") for x in open(f)]
    assert {x["table"] for x in lines} == set(frozen.tables())
