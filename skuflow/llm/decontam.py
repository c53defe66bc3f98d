"""Benchmark decontamination by winnowing (operator 1).

Every text is reduced to the least hash of each run of ``window - gram + 1``
word grams. Two texts that share ``window`` words in a row share all grams of
such a run, so both keep its least one: every shared span of ``window`` words is
found by joining the kept fingerprints. A joined fingerprint is then extended
word by word to both sides and counts if the equal words around it number
``window`` or more. A benchmark item with fewer words than a window is matched as
a whole; its length is then the gram and every gram of that length is kept.

Before the join, documents drop fingerprints whose bit is not set in a bitmap of
the benchmark's fingerprints. The bitmap has a fixed size (``BITMAP_BITS``), is
combined on the executors and only its words travel; with a huge benchmark it
fills up and merely drops less. Both sides of the join are dealt with a salt, so a
passage that a third of the documents quote is spread over many tasks.

Defined cases: a null or empty text has no words and no hits; a repeated row is
judged like any other, a null doc_id too (rows are told apart by a row number of
their own); a null item_id counts as hit words but names no item; an empty
benchmark hits nothing; an empty document table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import release, small_batches, stage, text_blocks

WINDOW, GRAM = 13, 5
BITMAP_BITS = 24
SALTS = 16
_SEED = "struct<h:bigint,p:int,l:array<string>,r:array<string>>"


def _fingerprints(data, offsets, window: int, gram: int, short: list[int], everywhere: bool):
    """Words of a block and its fingerprints: (start, end, first word of texts, positions, hashes)."""
    start, end, first = words.spans(data, offsets, words.ALNUM)
    hashes = words.word_hashes(data, start, end)
    grams, whole = words.gram_hashes(hashes, first, gram)
    at = [words.winnow(grams, whole, window - gram + 1)]
    found = [grams[at[0]]]
    for m in short:
        grams, whole = words.gram_hashes(hashes, first, m)
        if not everywhere:                       # an item: only the one that is the whole text
            sizes = np.diff(first)
            only = np.zeros(len(grams), bool)
            only[first[:-1][sizes == m]] = True
            whole &= only
        at.append(np.flatnonzero(whole))
        found.append(words.mix(grams[at[-1]] + np.uint64(m)))
    return start, end, first, np.concatenate(at), np.concatenate(found).astype(np.uint64)


def fingerprint(rows: DataFrame, window: int, gram: int, short: list[int], bitmap: np.ndarray | None) -> DataFrame:
    """Per row of (id, text): a row number, n_words and the kept fingerprints with the words around them."""
    small_batches(rows.sparkSession)
    shared = None if bitmap is None else rows.sparkSession.sparkContext.broadcast(bitmap)
    reach = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        base, number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36, 0
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                start, end, first, at, hashes = _fingerprints(data, offsets, window, gram, short, bits is not None)
                if bits is not None:
                    spot = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                    keep = (bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
                    at, hashes = at[keep], hashes[keep]
                order = np.argsort(at, kind="stable")
                at, hashes = at[order], hashes[order]
                row = np.searchsorted(first, at, side="right") - 1
                raw = words.LOWER[data].tobytes()
                head, tail = first[row], first[row + 1]
                # the words around each kept fingerprint, decoded once
                near = np.unique((at[:, None] + np.arange(-reach, window)[None, :]).ravel())
                near = near[(near >= 0) & (near < len(start))]
                known = {i: raw[s:e].decode("utf-8", "replace") for i, s, e in zip(near.tolist(), start[near].tolist(), end[near].tolist())}
                left = [[known[i] for i in range(p - 1, max(a, p - reach) - 1, -1)] for p, a in zip(at.tolist(), head.tolist())]
                right = [[known[i] for i in range(p, min(b, p + window))] for p, b in zip(at.tolist(), tail.tolist())]
                seeds = pa.StructArray.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array((at - head).astype(np.int32)),
                     pa.array(left, pa.list_(pa.string())), pa.array(right, pa.list_(pa.string()))], ["h", "p", "l", "r"])
                places = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + number + np.arange(hi - lo)), batch.column(0)[lo:hi], pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(places), seeds)], ["row", "id", "n_words", "seeds"])
                number += hi - lo
        release()

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"row bigint, id {kind}, n_words bigint, seeds array<{_SEED}>")


def _equal_words(a: str, b: str):
    """How many words at the head of two lists are equal."""
    same = f"zip_with({a}, {b}, (x, y) -> x <=> y)"
    return F.expr(f"coalesce(nullif(array_position({same}, false), 0) - 1, size({same}))")


def _bitmap(items: DataFrame) -> np.ndarray:
    """Bits of the items' fingerprints, combined by byte on the executors: at most 2**(BITMAP_BITS-3) bytes."""
    spot = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    marks = (items.select(F.explode("seeds.h").alias("h")).select(spot.alias("spot"))
             .groupBy((F.shiftright("spot", 3)).alias("byte"))
             .agg(F.bit_or(F.expr("cast(shiftleft(1, cast(spot & 7 as int)) as int)")).alias("bits")))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    found = marks.toArrow()
    out[found.column("byte").to_numpy()] = found.column("bits").to_numpy().astype(np.uint8)
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids (sorted strings), spans of hit words (first, end)."""
    spark = docs.sparkSession
    bench = bench.select(F.col("item_id").alias("id"), "text")
    short = list(range(1, window))
    items = stage(fingerprint(bench, window, gram, short, None), "benchmark")
    short = sorted(r[0] for r in items.where(f"n_words > 0 and n_words < {window}").select("n_words").distinct().collect())
    prints = stage(fingerprint(docs.select(F.col("doc_id").alias("id"), "text"), window, gram, short, _bitmap(items)), "fingerprints")
    seeds = (prints.where(F.size("seeds") > 0).select("row", F.inline("seeds"))
             .withColumn("salt", F.pmod(F.xxhash64("row", "p"), F.lit(SALTS)).cast("int")))
    known = (items.select(F.col("id").alias("item_id"), F.col("n_words").alias("item_words"), F.inline("seeds").alias("h", "ip", "il", "ir"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    joined = seeds.join(known, ["h", "salt"]).select(
        "row", "item_id", "p", "item_words", _equal_words("l", "il").alias("left"), _equal_words("r", "ir").alias("right"))
    long_ = (F.col("item_words") >= window) & (F.col("right") >= gram) & (F.col("left") + F.col("right") >= window)
    whole = (F.col("item_words") < window) & (F.col("right") >= F.col("item_words"))
    hits = (joined.where(long_ | whole)
            .select("row", "item_id", F.when(F.col("item_words") < window, F.col("p")).otherwise(F.col("p") - F.col("left")).alias("first"),
                    (F.col("p") + F.when(F.col("item_words") < window, F.col("item_words")).otherwise(F.col("right"))).alias("end"))
            .distinct())
    hits = stage(hits, "hits")
    # Spans of a document: a new one begins where a hit starts beyond all earlier ends.
    order = Window.partitionBy("row").orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (hits.select("row", "first", "end").distinct()
            .withColumn("fresh", (F.coalesce(F.col("first") > before, F.lit(True))).cast("int"))
            .withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "run").agg(F.min("first").alias("first"), F.max("end").alias("end")))
    per_row = runs.groupBy("row").agg(F.sum(F.col("end") - F.col("first")).alias("n_hit"),
                                      F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans"))
    per_item = (hits.where("item_id is not null").select("row", F.col("item_id").cast("string").alias("item")).distinct()
                .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids")))
    return (prints.select("row", F.col("id").alias("doc_id"), "n_words")
            .join(per_row, "row", "left").join(per_item, "row", "left")
            .select("doc_id", "n_words", F.coalesce(F.col("n_hit").cast("bigint"), F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans")))


def contaminated(n_hit, n_words):
    """The rule: some word is hit, and hits are a twentieth of the document's words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
