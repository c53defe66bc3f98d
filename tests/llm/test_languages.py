"""Rare languages are learned, and a corpus without languages is not dropped."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from skuflow.llm import langid

LETTERS = {"aa": "abcde", "bb": "vwxyz", "cc": "klmno"}


def text(rng, lang):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(3, 7))) for _ in range(30))


def test_rare_language_has_rows(spark):
    rng = random.Random(3)
    rows = [(None if i % 50 == 7 else i, text(rng, lang), lang) for i, lang in enumerate(["aa", "bb"] * 1500 + ["cc"] * 6)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    found = langid.identify(table, sample=60).select("lang_pred", "ambiguous").groupBy("lang_pred", "ambiguous").count().collect()
    assert {(r[0], r[1], r[2]) for r in found} == {("aa", False, 1500), ("bb", False, 1500), ("cc", False, 6)}


def test_quotas_are_bounded():
    taken = langid.quotas([("a", 10 ** 9), ("b", 5), ("c", 10 ** 6)], 2000)
    assert [(lang, n) for lang, n, _ in taken] == [("b", 5), ("c", 997), ("a", 998)]
    share = {lang: (below + (1 << 63)) / (1 << 64) for lang, _, below in taken}
    assert share["b"] == 1.0 and 998 * 1.5 < share["a"] * 10 ** 9 < 998 * 3


def test_nothing_learned_drops_nothing(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, "aa"), None) for i in range(20)] + [(20, "12 !?", None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert corpus_pipeline.language_id(spark, table, "").count() == 20
    assert not langid.identify(table).where(F.col("ambiguous") | (F.col("lang_pred") != "und")).count()
