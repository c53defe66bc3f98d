"""Removal of repeated 200-byte strings by suffix sorting (operator 3).

Every start of a ``LENGTH``-byte string is dealt by what it contains: the least hash
among the string's 32-byte grams is its anchor, and consecutive starts with one anchor
form a piece. The bytes that all strings of a piece have in common (its core, 116 of 200)
are the key: equal strings always lie in pieces of equal cores, at equal places.

1. A scan counts cores. Pieces whose core occurs once hold no repeated string.
2. A second scan returns the pieces of repeated cores; two bitmaps of a fixed size, combined
   on the executors, keep the others from being moved. Where all pieces of a core are equal,
   their strings repeat and nothing needs sorting; bytes travel only where pieces differ.
3. Differing pieces of a core, equal ones collapsed to one with a count, are sorted as
   suffixes in two stages: suffixes smaller than their successors are sorted directly, the
   rest is induced from them by one scan over the buckets of first bytes. Neighbours in the
   suffix array whose common prefix has LENGTH bytes or more repeat.
   A core with more than SPLIT_BYTES of differing pieces (a passage in very many texts, with
   other surroundings in each) is dealt anew before that: its pieces are cut into runs of
   GRAINS starts by their distance from the anchor, keyed by the longer core of such a run.
   At a grain of one start the core is the whole string, so no task gets more of one core.
4. The removed bytes are the union of repeated strings, cut out of each whole text.

Defined cases: a null text counts as empty; a text shorter than LENGTH keeps everything;
strings never cross texts; repeated rows remove each other; null ids and other columns
are harmless; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import small_batches, stage, text_blocks

LENGTH, GRAM = 200, 32
BITMAP_BITS = 25
#: Bytes of pieces that one suffix array holds (a core's pieces are never cut).
SORT_BYTES = 1 << 18
#: Bytes of differing pieces above which a core is dealt anew by runs of starts, first longer, then shorter.
SPLIT_BYTES, GRAINS = 1 << 20, (12, 1)
#: Parts into which the occurrences of one piece are dealt.
SALTS = 256
_PIECE = np.uint64(0x2545F4914F6CDD1D)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """Pieces of a block's texts: first start, number of starts, bytes from there to the anchor, core hash, hash of all bytes."""
    reach = length - GRAM                                   # places of a string's grams: 0 .. reach
    half = reach // 2
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(words.BYTE[data] * words.powers("step", words._STEP, len(data) + 1)[:len(data)], out=total[1:])
    back = words.powers("back", words._BACK, len(data) + 1)
    gram = words.mix((total[GRAM:] - total[:-GRAM]) * back[:len(total) - GRAM])
    low = np.uint64((1 << len(gram).bit_length()) - 1)
    anchor = (words._slide(gram & ~low | np.arange(len(gram), dtype=np.uint64), reach + 1, np.minimum) & low).astype(np.int64)
    starts = np.arange(len(anchor))
    inside = np.zeros(len(anchor) + 1, np.int64)
    long_ = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(inside, offsets[long_], 1)
    np.add.at(inside, offsets[long_ + 1] - length + 1, -1)
    valid = np.cumsum(inside)[:-1] > 0
    late = anchor - starts > half
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (late[1:] != late[:-1])
    first = np.flatnonzero(fresh)
    if not len(first):
        return none, none, none, none, none
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | fresh[1:]
    last = np.flatnonzero(ends)
    at, side = anchor[first], late[first]
    a = np.where(side, at - half - 1, at)
    b = np.where(side, at + GRAM, at + length - half)
    core = words.mix((total[b] - total[a]) * back[a] + side.astype(np.uint64))
    whole = (total[last + length] - total[first]) * back[first]
    whole = words.mix(whole * _PIECE + words.mix((at - first).astype(np.uint64) << np.uint64(20) | (last - first).astype(np.uint64)))
    return first, last - first + 1, at - first, core, whole


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _cores(rows: DataFrame, length: int) -> DataFrame:
    """core and hash of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                _, _, _, core, whole = pieces(data, offsets, length)
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))], ["core", "whole"])

    return rows.select("text").mapInArrow(run, "core bigint, whole bigint")


def _bitmap(cores: DataFrame) -> np.ndarray:
    """Bits of the cores' leading BITMAP_BITS, combined by 64 on the executors: 4 MB however many cores."""
    spot = F.shiftrightunsigned("core", 64 - BITMAP_BITS)
    found = (cores.select(spot.alias("s")).groupBy(F.shiftright("s", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")).toArrow())
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _has(bits: np.ndarray, core: np.ndarray) -> np.ndarray:
    spot = core >> np.uint64(64 - BITMAP_BITS)
    return bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1) == 1


def _candidates(rows: DataFrame, cores: DataFrame, length: int) -> DataFrame:
    """Pieces whose core's bit is set, with the text's digest, and their bytes where pieces of that core differ."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((_bitmap(cores.select("core")), _bitmap(cores.where("mixed").select("core"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, mixed = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(0)):
                first, n, lead, core, whole = pieces(data, offsets, length)
                if not len(first):
                    continue
                keep = np.flatnonzero(_has(repeated, core))
                first, n, lead, core, whole = first[keep], n[keep], lead[keep], core[keep], whole[keep]
                raw = data.tobytes()
                text = np.searchsorted(offsets, first, side="right") - 1
                digest = {i: hashlib.md5(raw[offsets[i]:offsets[i + 1]]).digest() for i in np.unique(text).tolist()}
                differs = _has(mixed, core).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array([digest[i] for i in text.tolist()], pa.binary()),
                     pa.array(first - offsets[text]), pa.array(n), pa.array(lead),
                     pa.array([raw[s:s + m + length - 1] if d else None for s, m, d in zip(first.tolist(), n.tolist(), differs)], pa.binary())],
                    ["core", "whole", "digest", "first", "n", "lead", "body"])

    return rows.select("text").mapInArrow(run, "core bigint, whole bigint, digest binary, first bigint, n bigint, lead bigint, body binary")


def two_stage_order(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of the bodies put together (each ends below all bytes, ties by place), the bytes, the bodies' first places.

    Suffixes smaller than their successor are sorted directly. All others follow
    from them: scanning the array upwards, the predecessor of each suffix goes to the
    next free place of its first byte's bucket, ahead of the directly sorted ones.
    """
    raw = b"".join(bodies)
    text = np.frombuffer(raw, np.uint8).astype(np.int16)
    size = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(size) - size
    n = len(text)
    following = np.append(text[1:], np.int16(-1))
    following[begin + size - 1] = -1                                     # the end of a body is below all bytes
    step = np.sign(following - text)
    told = np.where(step != 0, np.arange(n), n)
    told = np.minimum.accumulate(told[::-1])[::-1]                       # where a run of equal bytes is decided
    smaller = step[told] > 0
    stop = np.repeat(begin + size, size)
    direct = np.flatnonzero(smaller)
    direct = np.array(sorted(direct.tolist(), key=[raw[i:e] for i, e in zip(range(n), stop.tolist())].__getitem__), np.int64) if len(direct) else direct
    head = np.zeros(n, bool)
    head[begin] = True
    sorted_ = {c: direct[text[direct] == c] for c in np.unique(text[direct]).tolist()} if len(direct) else {}
    induced: dict[int, list[np.ndarray]] = {}

    def place(scanned: np.ndarray) -> None:
        before = scanned[~head[scanned]] - 1
        before = before[~smaller[before]]
        if not len(before):
            return
        of = text[before]
        order = np.argsort(of, kind="stable")
        before, of = before[order], of[order]
        cuts = np.flatnonzero(np.diff(of)) + 1
        for part in np.split(before, cuts):
            induced.setdefault(int(text[part[0]]), []).append(part)

    # the bodies' ends come first, in the order of the bodies
    last = begin + size - 1
    for part in [last[text[last] == c] for c in np.unique(text[last]).tolist()]:
        induced.setdefault(int(text[part[0]]), []).append(part)
    out: list[np.ndarray] = []
    for c in range(256):
        done = 0
        while c in induced and done < len(induced[c]):                   # grows while its own bytes precede
            part = induced[c][done]
            out.append(part)
            done += 1
            place(part)
        if c in sorted_:
            out.append(sorted_[c])
            place(sorted_[c])
    return np.concatenate(out) if out else np.zeros(0, np.int64), text.astype(np.uint8), begin


def repeated_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each body, the starts of ``length``-byte strings that occur at another place of the bodies too."""
    order, text, begin = two_stage_order(bodies)
    body = np.searchsorted(begin, order, side="right") - 1
    size = np.array([len(b) for b in bodies], np.int64)
    order, body = (x[order + length <= begin[body] + size[body]] for x in (order, body))
    flag = np.zeros(len(order), bool)
    if len(order) > 1:
        view = np.lib.stride_tricks.sliding_window_view(text, length)
        same = np.empty(len(order) - 1, bool)
        for lo in range(0, len(same), 1 << 16):
            hi = min(lo + (1 << 16), len(same))
            same[lo:hi] = (view[order[lo:hi]] == view[order[lo + 1:hi + 1]]).all(1)
        flag[1:] |= same
        flag[:-1] |= same
    order, body = order[flag], body[flag]
    by = np.argsort(body, kind="stable")
    cut = np.searchsorted(body[by], np.arange(len(bodies) + 1))
    return [np.sort(order[by[a:b]]) - begin[i] for i, (a, b) in enumerate(zip(cut[:-1], cut[1:]))]


def _sorted_ranges(mixed: DataFrame, length: int, sort_bytes: int) -> DataFrame:
    """Ranges of repeated starts of the pieces that occur once (digest, first, end)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        digests, lows, highs = [], [], []
        for (_, c, digest, first, body), starts in zip(rows, repeated_starts([r[4] for r in rows], length)):
            if c > 1 or not len(starts):
                continue
            cuts = np.flatnonzero(np.diff(starts) > 1)
            for a, b in zip(starts[np.append(0, cuts + 1)].tolist(), starts[np.append(cuts, len(starts) - 1)].tolist()):
                digests.append(digest)
                lows.append(first + a)
                highs.append(first + b + length)
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], ["digest", "first", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= sort_bytes and held[-1][0] != row[0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve(held)

    return mixed.select("core", "c", "digest", "first", "body").mapInArrow(run, "digest binary, first bigint, end bigint")


def _occurrences(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is in ``keys`` (distinct). One key may hold a third of all rows, so each is dealt by a salt as well."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("digest", "first"), F.lit(SALTS)))
    return rows.join(rows.select(*keys.columns, "salt").distinct().join(keys, keys.columns), [*keys.columns, "salt"])


def _split(pieces_: DataFrame, length: int, split_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """Distinct pieces with no core above ``split_bytes``, and the ranges found equal on the way.

    ``pieces_`` has core, c (occurrences), digest, first, lead (bytes to the anchor) and body.
    Equal strings have equal distances to their anchors, so they meet in equal runs.
    """
    done, ranges = [], []
    for grain in GRAINS:
        large = stage(pieces_.groupBy("core").agg(F.sum(F.length("body")).alias("bytes")).where(F.col("bytes") > split_bytes).select("core"), "large-cores")
        if large.isEmpty():
            break
        done.append(pieces_.join(large, "core", "left_anti"))
        starts = F.length("body") - length + 1
        runs = (pieces_.join(large, "core", "left_semi")
                .withColumn("low", F.col("lead") - starts + 1)
                .withColumn("run", F.explode(F.sequence(F.floor(F.col("low") / grain), F.floor(F.col("lead") / grain))))
                .withColumn("far", F.least("lead", F.col("run") * grain + grain - 1))
                .withColumn("near", F.greatest("low", F.col("run") * grain))
                .withColumn("skip", F.col("lead") - F.col("far")))
        common = F.substring("body", (F.col("lead") - F.col("run") * grain + 1).cast("int"), F.lit(length - grain + 1))
        runs = stage(runs.select(
            F.xxhash64("core", "run", common).alias("core"), "c", "digest", (F.col("first") + F.col("skip")).alias("first"), F.col("far").alias("lead"),
            F.substring("body", (F.col("skip") + 1).cast("int"), (F.col("far") - F.col("near") + length).cast("int")).alias("body")), "runs")
        one = stage(runs.groupBy("core", "body").agg(F.sum("c").alias("c"), F.min(F.struct("digest", "first")).alias("at"), F.min("lead").alias("lead")), "distinct-runs")
        equal = _occurrences(runs.where("c = 1"), one.where("c > 1").select("core", "body"))
        ranges.append(equal.select("digest", "first", (F.col("first") + F.length("body")).alias("end")))
        pieces_ = one.select("core", "c", "at.digest", "at.first", "lead", "body")
    for other in done:
        pieces_ = pieces_.union(other)
    return pieces_, ranges


def remove_repeats(docs: DataFrame, length: int = LENGTH, sort_bytes: int = SORT_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (removed byte ranges), kept (the remaining bytes)."""
    small_batches(docs.sparkSession)
    rows = _rows(docs)
    cores = (_cores(rows, length).groupBy("core").agg(F.count("*").alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
             .where("n > 1").select("core", (F.col("lo") != F.col("hi")).alias("mixed")))
    cores = stage(cores, "cores")
    found = stage(_candidates(rows, cores, length).join(cores, "core"), "pieces")
    span = ("digest", "first", (F.col("first") + F.col("n") + length - 1).alias("end"))
    mixed = found.where("mixed")
    one = stage(mixed.groupBy("core", "whole").agg(F.count("*").alias("c"), F.min(F.struct("digest", "first")).alias("at"),
                                               F.min("lead").alias("lead"), F.min("body").alias("body")), "distinct-pieces")
    copies = _occurrences(mixed, one.where("c > 1").select("core", "whole"))
    alone, equal = _split(one.select("core", "c", "at.digest", "at.first", "lead", "body"), length, split_bytes)
    alone = alone.repartition("core").sortWithinPartitions("core", "digest", "first")
    ranges = (found.where("not mixed").select(*span).union(copies.select(*span))
              .union(_sorted_ranges(alone, length, sort_bytes)))
    for more in equal:
        ranges = ranges.union(more)
    ranges = ranges.distinct()
    ranges = ranges.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, own in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                merged: list[dict] = []
                for r in own or []:
                    if merged and r["first"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], r["end"])
                    else:
                        merged.append(dict(r))
                edges = [0, *(x for r in merged for x in (r["first"], r["end"])), len(text)]
                sizes.append(len(text))
                spans.append(merged)
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "spans", "kept"])

    texts = rows.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    return (texts.join(ranges, texts["key"] == ranges["digest"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(cut, "doc_id bigint, n_bytes bigint, spans array<struct<first:bigint,end:bigint>>, kept binary"))
