"""MinHash near-duplicates with sequential Bayesian verification (operator 5).

1. Each text becomes its set of word shingles (64-bit hashes) and a MinHash
   signature. Texts with equal sets form one class, so exact copies cost one row.
2. Signatures are cut into bands; classes that agree on a band share a bucket. At
   the threshold of 0.8, 32 bands of 4 miss a pair with probability 5e-8.
3. A bucket of up to SMALL classes lists its pairs. A larger one compares all its
   classes with its least one; classes that are by then in one component need no
   further comparison. What is left - classes of different components in one bucket -
   is compared and verified in blocks of at most about BLOCK classes a side. A block
   returns only the links that join components, and compares a pair only in the first
   band that the two share, so pairs are never listed.
4. Every comparison reads the signatures batch by batch: after n hashes with m
   agreements the similarity has a Beta(m + 1, n - m + 1) posterior, and a pair
   goes as soon as the chance of reaching the threshold is below ``miss``.
5. Survivors are verified exactly on the whole shingle sets, and the verified links
   are contracted to components on Spark (large star / small star).

Defined cases: a null or empty text, or one without words, has no shingles, and
is linked with nothing; a text of fewer words than a shingle has one shingle, the
whole sequence; a null doc_id names no document: its rows are linked with nothing,
have a null component and are kept; repeated rows are one class; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import release, small_batches, stage, text_blocks

HASHES, ROWS_PER_BAND, BATCH = 128, 4, 16
SMALL, BLOCK = 8, 512
MISS = 1e-5
_rng = np.random.default_rng(99)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_SEED = _rng.integers(0, 1 << 63, HASHES // ROWS_PER_BAND, dtype=np.uint64)
_SET1, _SET2 = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    start, end, first = words.spans(data, offsets, words.NOT_SPACE)
    hashes = words.word_hashes(data, start, end)
    grams, _ = words.gram_hashes(hashes, first, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(words.gram_hashes(hashes[a:b], np.array([0, b - a]), b - a)[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the shingle set, signature (HASHES unsigned 32-bit values)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1), 1 << 19):
                sets = shingle_sets(data, offsets, k)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                signature = np.zeros((hi - lo, HASHES), np.uint32)
                keys = np.zeros((2, hi - lo), np.uint64)
                if len(full):
                    every = np.concatenate(sets)
                    at = (np.cumsum(n) - n)[full]
                    for i, salt in enumerate((_SET1, _SET2)):
                        keys[i, full] = np.add.reduceat(words.mix(every ^ salt), at)
                    short = (every >> np.uint64(32)).astype(np.uint32)
                    for j in range(HASHES):
                        value = (short ^ _XOR[j]) * _MUL[j]
                        value ^= value >> np.uint32(15)
                        value *= np.uint32(0x846CA68B)
                        value ^= value >> np.uint32(16)
                        signature[full, j] = np.minimum.reduceat(value, at)
                raw = signature.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                     pa.array([raw[i:i + 4 * HASHES] for i in range(0, len(raw), 4 * HASHES)], pa.binary())],
                    ["doc_id", "n_shingles", "k1", "k2", "signature"])
        release()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def _band_keys(signs: np.ndarray) -> np.ndarray:
    """The bucket key of each signature and band."""
    parts = signs.astype(np.uint64).reshape(len(signs), -1, ROWS_PER_BAND)
    key = np.broadcast_to(_BAND_SEED, parts.shape[:2]).copy()
    for j in range(ROWS_PER_BAND):
        key = words.mix(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, j])
    return key.view(np.int64)


def _bands(classes: DataFrame) -> DataFrame:
    """One row per class and band: bucket key, class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = np.asarray(batch.column(0))
            key = _band_keys(_matrix(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel()), pa.array(np.repeat(ids, key.shape[1]))], ["key", "cid"])

    return classes.select("cid", "signature").mapInArrow(run, "key bigint, cid bigint")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """cid and text of the documents whose id is in ``ids``, written once.

    The ids are few against the documents, so Spark may build a Bloom filter of
    them and drop other documents in the scan, before the shuffle.
    """
    conf = docs.sparkSession.conf
    conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1MB")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "64MB")
    ids = stage(ids.distinct(), "needed").where(F.col("cid") >= F.lit(-(1 << 63)))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("cid"), F.col("text").cast("string").alias("text"))
    texts = stage(texts.join(ids, "cid"), "texts")
    if texts.groupBy("cid").count().where("count > 1").limit(1).count():      # a doc_id with several rows
        texts = texts.distinct()
    return texts


def least_agreements(threshold: float, miss: float) -> dict[int, int]:
    """For each number of hashes read, the agreements below which a pair is given up.

    With a uniform prior, P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out[n] = m
    return out


def _survive(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the rows of two signature matrices that no batch gives up."""
    alive, agree = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, m in least.items():
        agree = agree + (a[alive, n - BATCH:n] == b[alive, n - BATCH:n]).sum(1)
        keep = agree >= m
        alive, agree = alive[keep], agree[keep]
    return alive


def _prune(pairs: DataFrame, classes: DataFrame, least: dict[int, int]) -> DataFrame:
    """Pairs (a, b) that the signatures' batches don't give up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = pa.array(_survive(_matrix(batch.column(2).to_pylist()), _matrix(batch.column(3).to_pylist()), least))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(alive), batch.column(1).take(alive)], ["a", "b"])

    left = classes.select(F.col("cid").alias("a"), F.col("signature").alias("sa"))
    right = classes.select(F.col("cid").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose whole shingle sets have 100 * intersection >= percent * union."""
    pairs = stage(pairs, "survivors")
    texts = _texts(docs, pairs.select(F.col("a").alias("cid")).union(pairs.select("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sets: list[list[np.ndarray]] = []
            for ids, column in ((0, 2), (1, 3)):
                one, inverse = np.unique(np.asarray(batch.column(ids)), return_index=True, return_inverse=True)[1:]
                own: list[np.ndarray] = []
                for _, _, data, offsets in text_blocks(batch.column(column).take(pa.array(one))):
                    own += shingle_sets(data, offsets, k)
                sets.append([own[i] for i in inverse.tolist()])
            linked = []
            for i, (x, y) in enumerate(zip(*sets)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    linked.append(i)
            at = pa.array(linked, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])
        release()

    small_batches(docs.sparkSession, 256)
    both = (pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a"))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the least node it reaches, roots themselves left out."""
    at = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = at.union(at.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a")
        at = stage(small.select("a", F.col("m").alias("b")).union(small.where("b > m").select("b", "m")).distinct(), "edges")
        now = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def _unlinked(members: DataFrame, classes: DataFrame, docs: DataFrame, least: dict[int, int], k: int, percent: int,
              block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) that join different components of a bucket, found block against block."""
    per = members.groupBy("key", "root").agg(F.count("*").alias("c"))
    mixed = (per.groupBy("key").agg(F.count("*").alias("roots"), F.sum(F.when(F.col("c") <= block, F.col("c")).otherwise(0)).alias("few"))
             .where("roots > 1"))
    many = F.col("c") > block
    per = per.join(mixed, "key").select(
        "key", "root", F.when(many, F.col("root")).otherwise(F.lit(-1)).alias("tag"), many.alias("own"),
        F.ceil(F.when(many, F.col("c")).otherwise(F.col("few")) / block).cast("int").alias("n"))
    blocks = per.select("key", "tag", "own", "n").distinct().withColumn("i", F.explode(F.expr("sequence(0, n - 1)")))
    one = blocks.select("key", *(F.col(c).alias(f"{c}1") for c in ("tag", "own", "i")))
    two = blocks.select("key", *(F.col(c).alias(f"{c}2") for c in ("tag", "own", "i")))
    against = one.join(two, "key").where(
        "struct(tag1, own1, i1) <= struct(tag2, own2, i2) and not (own1 and own2 and tag1 = tag2)")
    against = against.select("*", F.struct("tag1", "own1", "i1", "tag2", "own2", "i2").alias("pair"))
    sides = (against.select("key", "pair", F.col("tag1").alias("tag"), F.col("own1").alias("own"), F.col("i1").alias("i"), F.lit(0).alias("side"))
             .union(against.where("not (tag1 = tag2 and own1 = own2 and i1 = i2)")
                    .select("key", "pair", "tag2", "own2", "i2", F.lit(1))))
    placed = members.join(per, ["key", "root"]).withColumn("i", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
    rows = (placed.join(sides, ["key", "tag", "own", "i"]).join(classes.select("cid", "signature"), "cid")
            .join(_texts(docs, members.select("cid")), "cid"))

    def compare(frame):
        import pandas as pd

        frame = frame.sort_values(["side", "cid"], kind="stable")
        sides_, ids, roots = frame.side.to_numpy(), frame.cid.to_numpy(), frame.root.to_numpy().copy()
        signs = _matrix(frame.signature)
        bands = _band_keys(signs)
        own = (bands == frame.key.iat[0]).argmax(1)[0]              # the band of this bucket
        sets: list[np.ndarray] = []
        for _, _, data, offsets in text_blocks(pa.array(frame.text, pa.string())):
            sets += shingle_sets(data, offsets, k)
        other = np.flatnonzero(sides_ == 1) if sides_.any() else np.arange(len(ids))
        found: list[tuple[int, int]] = []
        for i in np.flatnonzero(sides_ == 0):
            j = other[roots[other] != roots[i]]
            if own:
                j = j[~(bands[j, :own] == bands[i, :own]).any(1)]   # pairs that share an earlier band are compared there
            j = j[_survive(np.broadcast_to(signs[i], (len(j), HASHES)), signs[j], least)]
            if not len(j) or not len(sets[i]):
                continue
            sizes = np.array([len(sets[m]) for m in j])
            flat = np.concatenate([sets[m] for m in j])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            for m in j[100 * both >= percent * (len(sets[i]) + sizes - both)]:
                if roots[m] != roots[i]:
                    found.append((min(ids[i], ids[m]), max(ids[i], ids[m])))
                    roots[roots == roots[m]] = roots[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (rows.select("key", "pair", "cid", "root", "side", "signature", "text").groupBy("key", "pair")
            .applyInPandas(compare, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id it is linked with over any way), kept."""
    docs = docs.select("doc_id", "text")
    least = least_agreements(percent / 100, miss)
    marked = stage(signatures(docs, shingle), "signatures")
    named = marked.where("doc_id is not null and n_shingles > 0")
    classes = stage(named.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("cid"), F.min("signature").alias("signature")), "classes")

    bands = _bands(classes)
    buckets = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(bands.join(buckets, "key"), "buckets")
    few = (members.where(F.col("size") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list("cid")).alias("c"))
           .select("c").distinct()
           .select(F.explode(F.expr("flatten(transform(c, (x, i) -> transform(slice(c, i + 2, size(c)), y -> struct(x as a, y as b))))")).alias("p"))
           .select("p.a", "p.b").where("a < b"))
    large = members.where(F.col("size") > SMALL).select("key", "cid")
    pivot = large.groupBy("key").agg(F.min("cid").alias("a"))
    star = large.join(pivot, "key").where("cid > a").select("a", F.col("cid").alias("b"))
    links = stage(_verify(_prune(few.union(star).distinct(), classes, least), docs, shingle, percent), "links")

    roots = components(links)
    placed = (large.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    open_ = stage(placed.join(mixed, "key", "left_semi"), "members")
    if not open_.isEmpty():
        more = stage(_unlinked(open_, classes, docs, least, shingle, percent), "links")
        roots = components(links.union(more))

    root_of = classes.select("k1", "k2", "n_shingles", "cid").join(roots, roots["node"] == F.col("cid"), "left").select(
        "k1", "k2", "n_shingles", F.coalesce("root", "cid").alias("component_id"))
    linked = named.select("doc_id", "n_shingles", "k1", "k2").join(root_of, ["k1", "k2", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = marked.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
