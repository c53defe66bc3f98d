"""Estimates and verdicts of the outlier rules against plain numpy, at every group size, however rows are dealt."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import outliers

SIZES = {("en", "a"): 400, ("en", "b"): 30, ("fr", "a"): 150, ("fr", None): 3, (None, "a"): 60, ("de", "c"): 1}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    rows = []
    for (lang, source), n in SIZES.items():
        for k in range(n):
            words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5 + len(lang or "")))) for _ in range(rng.randint(60, 300))]
            if k % 40 == 7:
                words = [w + "$$#" for w in words]
            rows.append((len(rows), " ".join(words), lang, source))
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")


def quantile_bin(values, width, share):
    bins = sorted(math.floor(v / width) for v in values)
    return bins[math.ceil(share * len(bins)) - 1]


def factor(c):
    low = np.zeros((4, 4))
    for i in range(4):
        for j in range(i + 1):
            rest = c[i, j] - low[i, :j] @ low[j, :j]
            low[i, j] = math.sqrt(max(rest, outliers.FLOOR)) if i == j else rest / low[j, j]
    return low


def distances(x, m, c):
    y = np.linalg.solve(factor(c), (x - m).T)
    return (y * y).sum(0)


def determinant(x):
    """Plain concentration steps on the rows of one group."""
    b = np.array([[quantile_bin(x[:, i], outliers.BIN, q) for q in (0.25, 0.5, 0.75)] for i in range(4)])
    m, c = (b[:, 1] + 0.5) * outliers.BIN, np.diag(((b[:, 2] - b[:, 0]) * outliers.BIN / 1.349) ** 2)
    for _ in range(outliers.STEPS):
        bins = np.floor(np.log1p(distances(x, m, c)) / outliers.FAR_BIN)
        inner = np.rint(x[bins <= np.sort(bins)[math.ceil(outliers.SUBSET * len(x)) - 1]] * 1e6) / 1e6
        m, c = inner.mean(0), np.cov(inner.T, bias=True).reshape(4, 4) * outliers.CONSISTENCY
    return len(x), m, c


def drawn(own, parent):
    n, m, c = own
    w = n / (n + outliers.PRIOR)
    return n, w * m + (1 - w) * parent[1], w * c + (1 - w) * parent[2]


def test_verdicts_equal_plain_ones(docs, texts):
    rows = [r for r in outliers.judge(docs).collect()]
    assert not any(r["base_failed"] for r in rows)
    n, chars = (np.array([r[c] for r in rows], float) for c in ("n_words", "word_chars"))
    x = np.stack([np.log1p(n), np.log(chars / n), np.log1p(100 * np.array([r["n_symbols"] for r in rows]) / chars), 2 * np.array([r["n_repeat_words"] for r in rows]) / n], 1)
    lang, source = [texts[r["doc_id"]][2] for r in rows], [texts[r["doc_id"]][3] for r in rows]
    whole = determinant(x)
    want = np.empty(len(rows))
    for a in set(lang):
        of_lang = np.array([v == a for v in lang])
        parent = drawn(determinant(x[of_lang]), whole)
        for b in {s for v, s in zip(lang, source) if v == a}:
            own = of_lang & np.array([s == b for s in source])
            _, m, c = drawn(determinant(x[own]), parent)
            want[own] = distances(x[own], m, c)
    got = np.array([r["distance"] for r in rows])
    assert got == pytest.approx(want, rel=1e-6)
    assert [r["kept"] for r in rows] == (want <= outliers.CUTOFF).tolist()
    signs = {t[0] for t in texts if "$$#" in t[1]}
    assert {r["doc_id"] for r in rows if not r["kept"]} == signs


def test_estimates_do_not_depend_on_partitions(docs):
    results = set()
    for n in (1, 3, 11):
        rows = outliers.judge(docs.repartition(n, "text")).select("doc_id", "distance", "kept").collect()
        results.add(tuple(sorted((r["doc_id"], r["distance"].hex(), r["kept"]) for r in rows)))
    assert len(results) == 1


def test_own_rows_weigh_more_with_their_number(spark, docs):
    """The same group among others, at two sizes: its centre moves from its language's to its own without a step."""
    shift = lambda n: docs.where("lang = 'en' and source = 'a'").union(spark.createDataFrame(
        [(10000 + i, " ".join(["abcdefghijklmno"] * 2 + [f"w{j}x{i}" for j in range(100)]), "en", "z") for i in range(n)], docs.schema))

    def centre(n):
        found = outliers.statistics(shift(n)).withColumn("x1", F.log1p("n_words"))
        for i, e in ((2, F.log(F.col("word_chars") / F.col("n_words"))), (3, F.lit(0.0)), (4, F.lit(0.0))):
            found = found.withColumn(f"x{i}", e)
        return outliers.estimates(found).where("source = 'z'").first()["m1"]

    alone = math.log1p(102)
    far = [abs(centre(n) - alone) for n in (5, 100, 199, 201, 800)]
    assert far == sorted(far, reverse=True) and far[2] - far[3] < 0.02
