"""Codewords for many languages; what ORC files of token ids hold, and how rows of one id are dealt."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import langid, orcids, tokens


@pytest.mark.parametrize("classes", [2, 5, 16, 50, 100, 300])
def test_codewords_stay_apart(classes):
    code = langid.codewords(classes)
    assert code.shape[0] == classes and set(np.unique(code)) <= {-1.0, 1.0}
    apart = (code.shape[1] - code @ code.T) / 2
    assert apart[~np.eye(classes, dtype=bool)].min() >= 5


def test_few_languages_keep_fifteen_bits():
    assert langid.codewords(4).shape == (4, 15) and langid.codewords(1).shape[0] == 1


def test_wrong_bits_are_corrected():
    """Two bits of a codeword decided wrongly, with confidence, for any of 300 classes."""
    rng = np.random.default_rng(4)
    code = langid.codewords(300)
    bits = code.shape[1]
    margin = code * 4
    for row in margin:
        row[rng.choice(bits, 2, replace=False)] *= -1
    w = np.zeros((bits + 1, bits), np.float32)
    w[:-1] = np.eye(bits) / 8
    best, score = langid.decode(margin.astype(np.float32), code, w)
    assert (best == np.arange(300)).all() and (score > 0).all() and (score <= 1).all()


def test_sixty_languages_are_told_apart(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    alphabets = [rng.sample(letters, 8) for _ in range(60)]
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(2, 6)))
    rows = [(i, " ".join(word(alphabets[i % 60]) for _ in range(60)), f"l{i % 60}", "s") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    found = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 300 and right >= 0.95 * n


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """5,000 documents of even ids, and 4,000 rows of a null id with different texts."""
    path = str(tmp_path_factory.mktemp("orc") / "ids")
    rows = [(2 * i, f"text number {i}") for i in range(5000)] + [(None, f"nobody {i}") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    orcids.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), path, tokens.vocabulary(), index_stride=1000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def rows_read(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    todo, most = [plan], 0
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if "Scan" in node.nodeName():
            most = max(most, node.metrics().get("numOutputRows").get().value())
    return most


def test_a_lookup_reads_one_row_group_and_a_bloom_filter_none(spark, files):
    rows = spark.read.schema(orcids.FILE_SCHEMA).orc(files).select("doc_id", "n_tokens")
    assert rows_read(rows) == 9000
    assert 0 < rows_read(rows.where("doc_id = 5000")) <= 1000              # the row index skips other groups
    odd = [rows_read(rows.where(f"doc_id = {i}")) for i in (501, 2501, 4501, 6501, 8501)]
    assert sum(n == 0 for n in odd) >= 4                                   # within the groups' bounds, yet not in their filters


def test_rows_of_one_id_go_to_several_files(spark, files):
    rows = spark.read.schema(orcids.FILE_SCHEMA).orc(files)
    assert rows.where("doc_id is null").select("part").distinct().count() > 1
    back = orcids.read(spark, files).select("doc_id", "start", "n_tokens", "ids").collect()
    order = sorted(back, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == [None] * 4000 + [2 * i for i in range(5000)]
    at = 0
    for r in order:
        assert r["start"] == at and len(r["ids"]) == r["n_tokens"]
        at += r["n_tokens"]
