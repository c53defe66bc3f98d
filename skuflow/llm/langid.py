"""Language identification with error-correcting output codes (operator 6).

Each language gets a codeword of ``BITS`` signs; the words are drawn so that the
least distance between any two is large. One binary logistic classifier per bit,
over hashed byte n-grams, predicts that bit. A text's margins are decoded by loss:
the language whose codeword has the least summed logistic loss wins, and its share
of exp(-loss) is the score. A text is ambiguous if no language has half of it.

The classifiers are fitted on at most ``SAMPLE`` rows (the bound is a parameter), dealt
evenly to the languages: what a rare one has not is left to the others, and each of
up to ``SAMPLE`` languages has a row. A language's rows are taken in the order of a hash
of id and text, from text and non-null lang of rows that are not held out. lang, source and doc_id are no inputs of a prediction.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; so
is every text if there are no rows to learn from; with one learned language every
text with a letter gets it; repeated rows, null ids and other columns are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import held_out, release, small_batches, text_blocks

SAMPLE, BINS, BITS, STEPS = 2000, 2048, 15, 80
#: Least number of bits in which two codewords differ: two wrong bits are corrected.
APART = 5
UNDETERMINED = "und"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.where(_LETTER, words.LOWER, 32).astype(np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Root counts of hashed 1- to 3-byte grams of letters per text, scaled to length 1."""
    texts = len(offsets) - 1
    out = np.zeros((texts, BINS), np.float32)
    if len(data) == 0:
        return out
    folded = _FOLD[data].astype(np.uint32)
    text = np.repeat(np.arange(texts, dtype=np.int64), np.diff(offsets))
    for n in (1, 2, 3):
        m = len(folded) - n + 1
        if m <= 0:
            break
        gram = np.full(m, n, np.uint32)
        for j in range(n):
            gram = gram * np.uint32(0x01000193) ^ folded[j:j + m]
        gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BINS.bit_length() + 1)
        own = (text[:m] == text[n - 1:]) & (folded[:m] != 32 if n == 1 else True)
        out += np.bincount(text[:m][own] * BINS + gram[own], minlength=texts * BINS).reshape(texts, BINS)
    out = np.sqrt(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def codewords(classes: int, bits: int = BITS, apart: int = APART, tries: int = 400) -> np.ndarray:
    """A (classes, bits or more) matrix of signs whose rows differ in ``apart`` places or more.

    Of random matrices that with the largest least distance is taken; bits grow with the
    logarithm of the classes, and further if no matrix is good enough.
    """
    rng, bits = np.random.default_rng(5), max(bits, 4 * (classes - 1).bit_length())
    while True:
        best, far = None, -1
        for _ in range(tries):
            code = np.where(rng.random((classes, bits)) < 0.5, -1.0, 1.0)
            if classes > 1:
                code = np.where(np.abs(code.sum(0)) == classes, np.where(np.arange(classes)[:, None] % 2, -code, code), code)
                differ = (bits - code @ code.T) / 2
                least = differ[~np.eye(classes, dtype=bool)].min()
            else:
                least = bits
            if least > far:
                best, far = code, least
            if far >= apart and classes > 16:                             # many pairs: good enough
                break
        if far >= apart:
            return best.astype(np.float32)
        bits += 1


def fit(x: np.ndarray, label: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords and the weights (last row: bias) of the classifiers of all bits."""
    code = codewords(classes)
    x = np.hstack([x * 8, np.ones((len(x), 1), np.float32)])
    target = code[label]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        margin = np.clip((x @ w) * target, -30, 30)
        grad = -(x.T @ (target / (1 + np.exp(margin)))) / len(x) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return code, w


def decode(x: np.ndarray, code: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and score of each row by the least summed logistic loss."""
    margin = np.clip(x @ (w[:-1] * 8) + w[-1], -30, 30)
    loss = np.log1p(np.exp(-margin)) @ (code > 0).T + np.log1p(np.exp(margin)) @ (code < 0).T
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    best = share.argmax(1)
    return best, share[np.arange(len(best)), best]


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate(([0], np.cumsum(_LETTER[data])))
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    plain = np.concatenate(([0], np.cumsum(_LETTER[data] & (data < 128))))
    for i in np.flatnonzero(out & (plain[offsets[1:]] == plain[offsets[:-1]])):     # only signs outside ASCII
        out[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def quotas(counts: list[tuple[str, int]], sample: int) -> list[tuple[str, int, int]]:
    """Of each language: its rows of the sample, and a bound on the 64-bit hash that more rows than these don't exceed."""
    out, left = [], sample
    for i, (lang, n) in enumerate(sorted(counts, key=lambda c: (c[1], c[0]))):
        quota = min(n, left // (len(counts) - i))
        share = 1.0 if n <= 4 * quota + 100 else (2 * quota + 30) / n
        out.append((lang, quota, min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63)))
        left -= quota
    return out


def train(docs: DataFrame, sample: int = SAMPLE):
    """Languages, codewords and weights from at most ``sample`` rows; None without rows to learn from."""
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    spark = docs.sparkSession
    known = (docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
             .select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("h")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()
    if not counts:
        return None
    taken = spark.createDataFrame(quotas([(r[0], r[1]) for r in counts], sample), "lang string, quota long, below long")
    # about twice the quota passes the bound on the hash, so the ranking sees a bounded number of rows
    some = known.join(F.broadcast(taken), "lang").where("h <= below").groupBy("lang", "quota", "h").agg(F.min("text").alias("text"))
    some = some.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where("n <= quota")
    rows = some.orderBy("h", "lang").select("lang", "text").mapInArrow(run, "lang string, x binary").toArrow()
    if rows.num_rows == 0:
        return None
    languages, label = np.unique(np.array(rows.column("lang").to_pylist()), return_inverse=True)
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, BINS)
    return languages.tolist(), *fit(x, label, len(languages))


def _predict(model, column: pa.Array):
    """Runs of rows of a text column: (first row, end row, languages, scores, whether a letter is there)."""
    for lo, hi, data, offsets in text_blocks(column):
        known = _has_letter(data, offsets)
        if model:
            languages, code, w = model
            best, score = decode(features(data, offsets), code, w)
            names = np.where(known, np.array(languages, object)[best], UNDETERMINED)
            score = np.where(known, score, 0.0)
        else:
            names, score = np.full(hi - lo, UNDETERMINED, object), np.zeros(hi - lo)
        yield lo, hi, names, score, known


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, ambiguous."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    shared = spark.sparkContext.broadcast(train(docs, sample))       # one row of weights per n-gram bin: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, names, score, known in _predict(shared.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(names, pa.string()), pa.array(score.astype(np.float64)), pa.array(known & (score < 0.5) & (shared.value is not None))],
                    ["doc_id", "lang_pred", "score", "ambiguous"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def with_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The table itself, all columns, without the rows whose text has no letter or is ambiguous; if nothing was learned, none is."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, sample))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, score, known in _predict(shared.value, batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(known & ((score >= 0.5) | (shared.value is None))))
        release()

    return docs.mapInArrow(run, docs.schema)
