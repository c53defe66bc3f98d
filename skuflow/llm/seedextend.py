"""Removal of repeated word sequences by seed and extend (operator 11).

A window is LENGTH consecutive words of one document. A document word is removed if some
window over it also starts earlier: in a document of a smaller id, or further ahead in the
same one. Windows are judged on the input.

1. Seeds. The least hash among a window's SEED-word grams is its anchor (winnowing: equal
   windows have equal anchors at equal places). Consecutive windows with one anchor form a
   piece, about one for seven words. A scan counts seeds; a seed that occurs once is dropped.
2. Join. A second scan returns the pieces of repeated seeds. Equal pieces of a seed are one
   class; all its members but the first are repeats as they stand, without an extension.
3. Extend. Where pieces of one seed differ, the first member of each class is extended from
   the anchor to every split of LENGTH - SEED words to its left and right. Extensions meet
   by (seed, words to the left, hash of the extended string), so the earliest partner of
   each is found by an aggregation, never by pairs of partners.
4. Keep maximal. Overlapping repeats of a text are merged to maximal ones, none below LENGTH
   words, and cut out of the whole text.

Two bitmaps of a fixed size keep the pieces of other seeds from being moved; they only
filter, the joins are exact. Equality rests on 128 bits (seed and content hashes).

Defined cases: a null text has no words; a text below LENGTH words keeps all; rows of one
doc_id are one document, so that exact repeats of a row (same id) keep their words; null
ids come last and count as one document; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import small_batches, stage, text_blocks
from skuflow.llm.suffixes import _bitmap as bitmap
from skuflow.llm.suffixes import _has as has

LENGTH, SEED = 20, 8
_PIECE = np.uint64(0xA0761D6478BD642F)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """Pieces of a block's texts: text, first word, windows, words from there to the anchor, seed hash, content hash, window hashes."""
    none = np.zeros(0, np.int64)
    start, end, first = words.spans(data, offsets, words.NOT_SPACE)
    if len(start) < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64)
    hashes = words.word_hashes(data, start, end, words.BYTE)
    gram, _ = words.gram_hashes(hashes, first, seed)
    low = np.uint64((1 << len(gram).bit_length()) - 1)
    anchor = words._slide(gram & ~low | np.arange(len(gram), dtype=np.uint64), length - seed + 1, np.minimum) & low
    anchor = anchor.astype(np.int64)                                  # of the window from each word on
    inside = np.zeros(len(start) + 1, np.int64)
    long_ = np.flatnonzero(np.diff(first) >= length)
    np.add.at(inside, first[long_], 1)
    np.add.at(inside, first[long_ + 1] - length + 1, -1)
    valid = np.cumsum(inside)[:len(anchor)] > 0
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | fresh[1:]
    at, stop = np.flatnonzero(fresh), np.flatnonzero(last)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * words.powers("word step", words._WORD_STEP, len(hashes) + 1)[:len(hashes)], out=total[1:])
    back = words.powers("word back", np.uint64(pow(int(words._WORD_STEP), -1, 1 << 64)), len(hashes) + 1)
    window = words.mix((total[length:] - total[:-length]) * back[:len(total) - length])
    lead, n = anchor[at] - at, stop - at + 1
    whole = (total[stop + length] - total[at]) * back[at]
    whole = words.mix(whole * _PIECE + words.mix((lead.astype(np.uint64) << np.uint64(32)) | n.astype(np.uint64)))
    text = np.searchsorted(first, at, side="right") - 1
    return text, at - first[text], n, lead, gram[anchor[at]], whole, (at, window)


def _seeds(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """Seed and content hash of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                _, _, _, _, core, whole, _ = pieces(data, offsets, length, seed)
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))], ["core", "whole"])

    return rows.select("text").mapInArrow(run, "core bigint, whole bigint")


def _candidates(rows: DataFrame, seeds: DataFrame, length: int, seed: int) -> DataFrame:
    """Pieces whose seed's bit is set; the hashes of their windows only where pieces of that seed differ."""
    shared = rows.sparkSession.sparkContext.broadcast((bitmap(seeds.select("core")), bitmap(seeds.where("mixed").select("core"))))
    names = ["core", "whole", "doc_id", "row", "first", "n", "lead", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, mixed = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(2)):
                text, first, n, lead, core, whole, rest = pieces(data, offsets, length, seed)
                if not len(text):
                    continue
                keep = np.flatnonzero(has(repeated, core))
                at, window = rest
                at, text, first, n, lead, core, whole = (x[keep] for x in (at, text, first, n, lead, core, whole))
                differs = has(mixed, core)
                size = np.where(differs, n, 0)
                ends = np.cumsum(size)
                inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(at, size)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(window[inner].view(np.int64)))
                of = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                     pa.array(first), pa.array(n), pa.array(lead), lists], names)

    return rows.select("doc_id", "row", "text").mapInArrow(
        run, "core bigint, whole bigint, doc_id bigint, row bigint, first bigint, n bigint, lead bigint, windows array<bigint>")


def _place(start: str):
    """The order of windows: by document, null ids last, then by start."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(start).alias("start"))


def _repeats(found: DataFrame, length: int) -> DataFrame:
    """Word ranges (doc_id, row, first, end) that repeat earlier ones."""
    # Written first: a join of two plain shuffles is one whose hot keys AQE can split.
    classes = stage(found.groupBy("core", "whole").agg(F.min(_place("first")).alias("head"), F.count("*").alias("members")).where("members > 1").drop("members"), "classes")
    later = found.join(classes, ["core", "whole"]).where(_place("first") > F.col("head"))
    later = later.select("doc_id", "row", "first", (F.col("first") + F.col("n") + length - 1).alias("end"))
    heads = (found.where("mixed").groupBy("core", "whole")
             .agg(F.min(F.struct(_place("first").alias("place"), "row")).alias("head"), F.first("lead").alias("lead"), F.first("windows").alias("windows")))
    extended = stage(heads.select("core", "lead", "head.place.doc_id", "head.row", F.col("head.place.start").alias("first"), F.posexplode("windows").alias("o", "hash"))
                     .select("core", (F.col("lead") - F.col("o")).alias("left"), "hash", "doc_id", "row", (F.col("first") + F.col("o")).alias("first")), "extensions")
    key = ["core", "left", "hash"]
    earliest = stage(extended.groupBy(*key).agg(F.min(_place("first")).alias("head"), F.count("*").alias("members")).where("members > 1").drop("members"), "earliest")
    joined = extended.join(earliest, key).where(_place("first") > F.col("head"))
    return later.union(joined.select("doc_id", "row", "first", (F.col("first") + length).alias("end")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        n_words, spans, kept = [], [], []
        for text, own in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            split = (text or b"").split()
            merged: list[dict] = []
            for r in own or []:
                if merged and r["first"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], r["end"])
                else:
                    merged.append(r)
            edges = [0, *(x for r in merged for x in (r["first"], r["end"])), len(split)]
            n_words.append(len(split))
            spans.append(merged)
            kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in split[a:b]) if merged else b" ".join(split))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())],
                                         ["doc_id", "n_words", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, spans (removed word ranges), kept (the remaining words, joined by one space)."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    seeds = _seeds(rows, length, seed).groupBy("core").agg(F.count("*").alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
    seeds = stage(seeds.where("n > 1").select("core", (F.col("lo") != F.col("hi")).alias("mixed")), "seeds")
    found = stage(_candidates(rows, seeds, length, seed).join(seeds, "core"), "seed-pieces")
    ranges = (_repeats(found, length).groupBy("doc_id", "row")
              .agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("ranges")).withColumnRenamed("row", "of").withColumnRenamed("doc_id", "id"))
    same = rows["doc_id"].eqNullSafe(ranges["id"]) & (rows["row"] == ranges["of"])
    return (rows.join(ranges, same, "left").select("doc_id", "text", "ranges")
            .mapInArrow(_cut, "doc_id bigint, n_words bigint, spans array<struct<first:bigint,end:bigint>>, kept string"))
