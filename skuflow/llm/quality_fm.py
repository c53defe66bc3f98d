"""Quality classifier: a factorisation machine (operator 4).

Inputs of a text are its hashed words and structure statistics (lengths, shares of
capitals, digits, signs, repeated words and lines). Besides a weight, each input
has a vector of ``FACTORS`` numbers, and each pair of inputs interacts by the product
of its vectors. The sum over all pairs is computed in linear time as half of
(sum of v x) squared less the sum of (v x) squared.

Labels are learned from at most ``SAMPLE`` labelled rows that are not held out (the
bound is a parameter; rows are taken in the order of a hash of their id). Labels,
lang, source and doc_id are no inputs of a score.

Defined cases: a null or empty text has only the bias and its statistics and gets a
score like any other; without labelled rows every score is 0.5; conflicting labels
of a doc_id count as its lowest; null ids or labels teach nothing; repeated rows and
other columns are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import held_out, small_batches, text_blocks

SAMPLE, WORD_BITS, FACTORS, STEPS = 4000, 13, 8, 60
_BINS = 1 << WORD_BITS
STATISTICS = ("bias", "words", "word length", "capitals", "digits", "signs", "rare signs", "distinct words", "lines",
              "repeated lines", "bytes")
INPUTS = _BINS + len(STATISTICS)
_CAPITAL, _DIGIT, _SIGN, _RARE = (np.zeros(256, bool) for _ in range(4))
_CAPITAL[65:91], _DIGIT[48:58] = True, True
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_RARE[[ord(c) for c in "#*$%&|<>{}=_\\^~@"]] = True


def _share(flags: np.ndarray, offsets: np.ndarray, size: np.ndarray) -> np.ndarray:
    seen = np.concatenate(([0], np.cumsum(flags)))
    return (seen[offsets[1:]] - seen[offsets[:-1]]) / size


def inputs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a block's texts: where each row's inputs begin, their indices and values."""
    texts = len(offsets) - 1
    start, end, first = words.spans(data, offsets, words.NOT_SPACE)
    hashed = words.word_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    n = np.diff(first)
    text = np.repeat(np.arange(texts, dtype=np.uint64), n)
    key, count = np.unique(text << np.uint64(WORD_BITS) | hashed >> np.uint64(64 - WORD_BITS), return_counts=True)
    row = (key >> np.uint64(WORD_BITS)).astype(np.int64)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(row, value * value, texts))
    value = value / norm[row]
    lines = np.flatnonzero(data == 10)
    size, many = np.maximum(np.diff(offsets), 1), np.maximum(n, 1)
    distinct = np.bincount(row, minlength=texts)
    begin = np.union1d(offsets[:-1], lines + 1)
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    line = words.word_hashes(data, begin, stop) if len(begin) else np.zeros(0, np.uint64)
    line_text = np.searchsorted(offsets, begin, side="right") - 1
    pair = np.unique(np.stack([line_text.astype(np.uint64), line]), axis=1)[0].astype(np.int64)
    per_text = np.bincount(line_text, minlength=texts)
    repeated = (per_text - np.bincount(pair, minlength=texts)) / np.maximum(per_text, 1)
    length = np.bincount(text.astype(np.int64), end - start, texts) / many
    stats = np.stack([np.ones(texts), np.log1p(n) / 5, length / 8, _share(_CAPITAL[data], offsets, size) * 4,
                      _share(_DIGIT[data], offsets, size) * 8, _share(_SIGN[data], offsets, size) * 8,
                      _share(_RARE[data], offsets, size) * 8, distinct / many, np.log1p(per_text) / 4, repeated * 2,
                      np.log1p(np.diff(offsets)) / 8], 1)
    k = stats.shape[1]
    begins = np.concatenate(([0], np.cumsum(distinct + k)))
    index, out = np.empty(begins[-1], np.int64), np.empty(begins[-1])
    spot = (begins[:-1, None] + np.arange(k)).ravel()
    rest = np.ones(begins[-1], bool)
    rest[spot] = False
    index[spot], out[spot] = np.tile(_BINS + np.arange(k), texts), stats.ravel()
    index[rest], out[rest] = (key & np.uint64(_BINS - 1)).astype(np.int64), value
    return begins, index, out


def margins(begins: np.ndarray, index: np.ndarray, value: np.ndarray, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's sums, and each row's sum of v x (every row has inputs)."""
    vx = v[index] * value[:, None]
    total = np.add.reduceat(vx, begins[:-1], axis=0)
    pairs = 0.5 * (total ** 2 - np.add.reduceat(vx * vx, begins[:-1], axis=0)).sum(1)
    return np.add.reduceat(w[index] * value, begins[:-1]) + pairs, total


def fit(begins: np.ndarray, index: np.ndarray, value: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and vectors by gradient steps on the logistic loss."""
    rng = np.random.default_rng(3)
    w, v = np.zeros(INPUTS), rng.normal(0, 0.05, (INPUTS, FACTORS))
    row = np.repeat(np.arange(len(label)), np.diff(begins))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    for step in range(1, STEPS + 1):
        z, total = margins(begins, index, value, w, v)
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
        pull = off[row] * value
        grad_w = np.bincount(index, pull, INPUTS) + 1e-5 * w
        inner = total[row] - v[index] * value[:, None]
        grad_v = np.stack([np.bincount(index, pull * inner[:, f], INPUTS) for f in range(FACTORS)], 1) + 1e-5 * v
        for i, (x, g) in enumerate(((w, grad_w), (v, grad_v))):
            m, s = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            x -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return w, v


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Weights and vectors; None without labelled rows."""
    small_batches(docs.sparkSession, 256)
    # At most ``sample`` ids, so this side of the join is small at any scale.
    taught = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                begins, index, value = inputs(data, offsets)
                cut = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array([index[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                     pa.array([value[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary())], ["quality", "i", "x"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(taught), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(sample)
            .select("quality", "text").mapInArrow(run, "quality int, i binary, x binary").toArrow())
    if rows.num_rows == 0:
        return None
    index = [np.frombuffer(b, np.int32) for b in rows.column("i").to_pylist()]
    begins = np.concatenate(([0], np.cumsum([len(i) for i in index])))
    value = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).astype(np.float64)
    return fit(begins, np.concatenate(index).astype(np.int64), value, rows.column("quality").to_numpy() > 0)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))      # INPUTS rows: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                z = np.zeros(hi - lo) if model is None else margins(*inputs(data, offsets), *model)[0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    found = docs.mapInArrow(run, "doc_id bigint, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
