"""The stages of the corpus pipeline on rows with null and repeated ids."""

from __future__ import annotations

import collections
import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ALPHABETS = {"aa": "abcde", "bb": "vwxyz"}


def prose(rng, n, letters="abcde"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rng():
    return random.Random(12)


@pytest.fixture(scope="module")
def passage(rng):
    return prose(rng, 40)


@pytest.fixture(scope="module")
def sf_dir(spark, passage, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], SCHEMA).repartition(3)


def texts(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def counted(rows):
    return collections.Counter((i, t) for i, t, _ in rows)


def test_language_goes_by_row(spark, rng, sf_dir):
    clean = [(i, prose(rng, 40, ALPHABETS[lang]), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    clean += [(None, prose(rng, 40), "aa"), (None, prose(rng, 40, "vwxyz"), "bb")]
    rejected = [(None, "12 !?", None), (3, "", "aa"), (4, None, "bb")]
    kept = corpus_pipeline.language_id(spark, table(spark, clean + rejected), sf_dir)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert texts(kept) == counted(clean)
    assert corpus_pipeline.language_id(spark, table(spark, clean).limit(0), sf_dir).count() == 0


def test_near_duplicates_go_by_row(spark, rng, sf_dir):
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    near = " ".join(w if i != 30 else "changed" for i, w in enumerate(a.split()))
    kept = [(5, a, "aa"), (5, b, "aa"), (5, c, "aa"), (None, d, "aa"), (None, e, "aa"), (None, "", "aa"), (None, None, "aa"), (5, "", "aa")]
    gone = [(9, near, "aa"), (None, b, "aa"), (7, c, "aa"), (None, d, "aa"), (5, a, "aa")]
    got = corpus_pipeline.near_duplicates(spark, table(spark, gone + kept), sf_dir)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert texts(got) == counted(kept)
    assert corpus_pipeline.near_duplicates(spark, table(spark, kept).limit(0), sf_dir).count() == 0


def test_decontamination_goes_by_row(spark, rng, passage, sf_dir):
    clean = [(None, prose(rng, 60), "aa"), (2, prose(rng, 60), "aa"), (2, prose(rng, 60), "aa"), (None, None, "aa"), (3, "", "aa")]
    bad = [(None, passage + " " + prose(rng, 10), "aa"), (2, passage, "aa"), (3, prose(rng, 5) + " " + passage, "aa")]
    got = corpus_pipeline.decontamination(spark, table(spark, clean + bad), sf_dir)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert texts(got) == counted(clean)


def test_run_equals_a_plain_version(spark, rng, passage, sf_dir):
    """All stages in a row against plain Python, counted in token ids per doc_id."""
    from test_llm_operators import near_brute, whole_ids

    from skuflow.llm import pii

    rows = [(i % 30, prose(rng, 40, ALPHABETS[lang]) + " a.b@example.com 97.51.17.173", lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    rows += [(None, prose(rng, 40, ALPHABETS[lang]), lang) for lang in ("aa", "bb", "aa")]
    rows += [(None, rows[0][1], "aa"), (7, rows[4][1], "aa"), rows[9], (11, " ".join(rows[41][1].split()[:-1]), "bb")]
    rows += [(None, "12 !?", None), (3, "", "aa"), (4, None, "bb"), (None, passage, "aa"), (5, prose(rng, 5) + " " + passage, "aa")]
    table(spark, rows).write.parquet(f"{sf_dir}/documents.parquet")

    left = sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=lambda r: (r[0] is None, r[0] or 0))
    root = near_brute([t for _, t, _ in left], 5, 80)[1]
    left = [r for i, r in enumerate(left) if root[i] == i]
    words = passage.split()
    windows = {tuple(words[i:i + 13]) for i in range(len(words) - 12)}

    def contaminated(text):
        own = text.split()
        hit = {j for i in range(len(own) - 12) if tuple(own[i:i + 13]) in windows for j in range(i, i + 13)}
        return bool(hit) and 20 * len(hit) >= len(own)

    left = [r for r in left if not contaminated(r[1])]
    permute = pii.Permutation(pii.KEY)
    want = collections.defaultdict(collections.Counter)
    for (i, _, _), ids in zip(left, whole_ids([pii.pseudonymise(t, permute)[0] for _, t, _ in left])):
        want[i].update(ids)
    got = collections.defaultdict(collections.Counter)
    for piece in corpus_pipeline.run(spark, sf_dir).collect():
        got[piece.doc_id].update(memoryview(bytes(piece.ids)).cast("I").tolist())
    assert len(left) == 43
    assert got == want
