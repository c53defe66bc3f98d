"""The corpus pipeline: language ID, near-duplicates, decontamination, pseudonyms, packing.

Each stage works on all that its predecessor kept and is written as Parquet and read
again. Every stage but the last returns the columns of ``documents``. Each row is a
document of its own, whatever its doc_id: a stage decides for rows, so rows with a null
or repeated doc_id go only for what their own text is. Null and empty texts: the language
stage rejects them, the others keep them (an empty text is packed as its end id). Texts of any
length are judged whole; further columns pass through, whatever their names; an empty table
gives an empty one.

A stage's scratch tables are deleted when the next stage begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import decontam, langid, neardup, packing, pii, tokens
from skuflow.llm.common import free_name, stage, step, without


@step
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no letter, or no language with half of the decoded score."""
    return langid.with_language(docs)


@step
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: that with the least id (null last), of several the first one.

    Unique ids name the rows. If ids are null or repeated, rows are numbered, for which the
    table is written once more.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("doc_id is null or n > 1").isEmpty():
        found = stage(neardup.near_duplicates(docs), "near-duplicates")
        return without(docs, found.where(~F.col("kept")).select("doc_id"), "doc_id")
    row = free_name(docs, "_row")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = stage(neardup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")), "near-duplicates")
    found = found.select(F.col("doc_id").alias(row), F.col("component_id").alias("group")).join(rows.select(row, "doc_id"), row)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("least"))
    dropped = stage(found.join(first.select(f"least.{row}"), row, "left_anti").select(row), "dropped")
    return without(rows, dropped, row).select(*docs.columns)


@step
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more of the words are benchmark passages.

    The verdict depends on the text alone, so a row is named by the SHA-256 of its text.
    """
    row, name = free_name(docs, "_row"), F.sha2(F.col("text").cast("binary"), 256)
    found = decontam.decontaminate(docs.select(name.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = stage(found.where(decontam.contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias(row)).distinct(), "contaminated")
    return without(docs.withColumn(row, name), bad, row).select(*docs.columns)


@step
def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; no document goes."""
    return pii.pseudonymise_table(docs)


@step
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all remaining documents; returns pieces."""
    return packing.pack(docs, tokens.vocabulary())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("packing", pack),
]

#: A fitted classifier and a tokenizer are not expressible in SQL; tests/llm compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name}")
    return docs
