"""Publish the star: write once, check what was written, then make it the current one.

Every publication is a folder of its own, ``{path}/versions/{version}``. Each table is computed
and written once; its rows are counted on the way (``Observation``). The written files are read
again: row counts must equal the observed ones, the columns must be the declared ones, and the
star checks (Q14-Q17) run on the files. Only then a manifest is written to
``{path}/manifests/{version}``; a reader takes the newest manifest, so a failed or unfinished
publication leaves the last good star in place, and readers of that one are not disturbed.

Facts are dealt by month with REBALANCE: AQE joins small months and splits large ones by size,
so the number of files follows the data and not months times tasks.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.plans.star import Star, assert_valid, build_star, star_checks
from skuflow.session import ensure_checkpoint_dir
from skuflow.sources.model import Model

FORMATS = ("parquet", "csv")
MANIFEST = "table string, rows bigint, columns array<string>, ddl string, format string, version string"
_MONTH = "year_month"


@dataclass(frozen=True)
class Publication:
    version: str
    audit: DataFrame        # one row per table: MANIFEST


class PublicationFailed(RuntimeError):
    """What was written is not what was meant; the current star is unchanged."""


def _by_month(name: str, df: DataFrame) -> bool:
    return name.startswith("fact_") and "date_key" in df.columns


def _write(df: DataFrame, name: str, path: str, fmt: str) -> int:
    """Write one table; rows as counted in that pass."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = df
    if _by_month(name, df):
        out = out.withColumn(_MONTH, F.floor(F.col("date_key") / 100).cast("int")).hint("rebalance", _MONTH)
    write = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if _by_month(name, df):
        write = write.partitionBy(_MONTH)
    write = write.option("header", True) if fmt == "csv" else write
    write.format(fmt).save(f"{path}/{name}")
    return seen.get["rows"]


def _read(spark: SparkSession, path: str, name: str, schema: T.StructType, fmt: str) -> DataFrame:
    """A written table with its declared columns; CSV columns are compared with the header line."""
    read = spark.read.option("basePath", f"{path}/{name}")
    if fmt == "csv":
        read = read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return read.format(fmt).load(f"{path}/{name}").select(*schema.fieldNames())


def publish_star(star: Star, path: str, fmt: str = "parquet") -> Publication:
    """Write, check and publish; raises ``PublicationFailed`` without touching the current star."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    spark = star.fact_sales.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/versions/{version}"
    rows, written = [], {}
    for name, df in star.tables().items():
        n = _write(df, name, folder, fmt)
        try:
            written[name] = _read(spark, folder, name, df.schema, fmt)
        except AnalysisException as e:
            raise PublicationFailed(f"{name}: {e}") from e
        rows.append((name, n, df.columns, df.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), fmt, version))
    wrong = [f"{name}: {found} rows in the files, {n} written" for name, n, *_ in rows if (found := written[name].count()) != n]
    if wrong:
        raise PublicationFailed("; ".join(wrong))
    try:
        assert_valid(star_checks(Star(**written)))
    except RuntimeError as e:
        raise PublicationFailed(str(e)) from e
    audit = spark.createDataFrame(rows, MANIFEST)
    audit.coalesce(1).write.json(f"{path}/manifests/{version}")
    return Publication(version, audit)


def current_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest manifest; manifests are a handful of rows, and appear when they are complete."""
    every = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{path}/manifests")
    newest = every.agg(F.max("version").alias("version"))
    return every.join(F.broadcast(newest), "version", "left_semi")


def read_star(spark: SparkSession, path: str) -> Star:
    """The current star."""
    tables = {r["table"]: r for r in current_manifest(spark, path).collect()}
    return Star(**{name: _read(spark, f"{path}/versions/{r['version']}", name, T.StructType.fromDDL(r["ddl"]), r["format"]) for name, r in tables.items()})


def publication_audit(m: Model, fmt: str = "parquet") -> DataFrame:
    """The model's star published below the checkpoint folder: rows and columns of every table, as read from the current star."""
    path = f"{ensure_checkpoint_dir(m.spark).rstrip('/')}/star-{uuid.uuid4().hex}"
    publish_star(build_star(m), path, fmt)
    return current_manifest(m.spark, path).select(F.col("table").alias("table_name"), F.col("rows").alias("row_count"),
                                                  F.size("columns").alias("column_count"), F.array_join("columns", ",").alias("column_names"))
