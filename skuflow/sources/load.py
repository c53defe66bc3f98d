"""Load the model once - each binding stage written and read back.

The stages are written as Parquet under the cluster's checkpoint directory
(``spark.checkpoint.dir``, a shared folder on a cluster), so every later query
reads finished tables instead of recomputing the derivation, and a lost
executor costs a re-read, not a re-derivation.  Writes overwrite, so a rerun
is idempotent.
"""

from __future__ import annotations

import hashlib
import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.session import ensure_checkpoint_dir, shuffles_for, shuffles_freed
from skuflow.sources.model import Model, record_stats
from skuflow.sources.tpch import PHASES, model_from_stages, read_sources, source_version

# Rows are clustered by date inside each file so that Parquet row-group statistics can skip date
# ranges. Lines stay in the order of their numbering: one more sort of rows this wide is what spills.
_DATE_SORT = {"orders": ["order_date"]}


def model_path(spark: SparkSession, sf_dir: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    mark = hashlib.sha256(f"{sf_dir}\n{source_version(spark, sf_dir)}".encode()).hexdigest()[:24]
    slug = re.sub(r"[^A-Za-z0-9._-]+", "_", sf_dir.strip("/"))[-60:] + "-" + mark
    return f"{base}/skuflow-model/{slug}"


def load_model(spark: SparkSession, sf_dir: str, path: str | None = None, seconds: dict[str, float] | None = None) -> Model:
    """The model from its sources, written to ``path``; ``seconds`` receives the time of each stage."""
    out = path or model_path(spark, sf_dir)

    def stage(name: str, df: DataFrame) -> DataFrame:
        begun = time.perf_counter()
        if name in _DATE_SORT:
            df = df.sortWithinPartitions(*_DATE_SORT[name])
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        if seconds is not None:
            seconds[name] = round(time.perf_counter() - begun, 2)
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    src = read_sources(spark, sf_dir)
    staged: dict[str, DataFrame] = {}
    # Stages of one phase are independent: submit their jobs concurrently so
    # small stages overlap instead of queueing behind each other.
    with shuffles_for(spark, src["lineitem"].count()), shuffles_freed(spark), ThreadPoolExecutor(max_workers=max(len(p) for p in PHASES)) as pool:
        for phase in PHASES:
            plans = {name: build(src, staged) for name, build in phase}
            futures = {name: pool.submit(stage, name, df) for name, df in plans.items()}
            for name, fut in futures.items():
                staged[name] = fut.result()
    max_ship = staged["lines"].agg(F.max("ship_date")).first()[0]
    model = model_from_stages(staged, max_ship)
    return replace(model, stats=record_stats(model))


def load_csv(spark: SparkSession, path: str, dollars: bool = True) -> Model:
    """Read the CSV files of a model and stop on any broken reference."""
    from skuflow.operators.quality import assert_references

    model = Model.read_csv(spark, path, dollars)
    assert_references(model)
    return model
