"""Cost-balanced packing of documents into fixed-length token sequences (operator 10).

A training step over a packed sequence costs a linear part per token and a
quadratic attention part per document piece. Documents are tokenised and cut:
full sequences' worth of tokens of one document become sequences of their own,
and the rests are assigned in descending order, each to the sequence that costs
least so far among those with room for it; a rest that fits nowhere whole is cut
at the room of the cheapest sequence that has any.

Packing works on runs of ``pack_tokens`` tokens within a task, so memory is
bounded and nothing is shuffled. Of each run the tokens beyond whole sequences
go to sequences whose lengths are powers of two (they need no padding), so no
token of padding remains.

Null text counts as empty (a document of the end id alone), rows repeat or share
ids freely (each row is packed once), an empty table gives no pieces, and other
columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import tokens
from skuflow.llm.common import release, small_batches, text_blocks

SCHEMA = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, sequence_tokens bigint, sequence_cost double, ids binary")
SEQUENCE_TOKENS = 4096
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n (a model of width about 4096).
LINEAR, QUADRATIC = 24576.0, 1.0
PACK_TOKENS = 1 << 21
#: Pieces that a task gives back at a time.
BATCH = 512


def sequences(total: int, capacity: int) -> int:
    """Sequences of a run of ``total`` tokens: whole ones, and one for each power of two in the rest."""
    return total // capacity + (total % capacity).bit_count()


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Cut and assign documents of one run: (document, start, length, sequence) with gapless sequences.

    Deterministic: longer rests first, ties by position, then the lower sequence.
    """
    out: list[tuple[int, int, int, int]] = []
    sequence, rests = 0, []
    for k, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            out.append((k, start, capacity, sequence))
            sequence += 1
        if n % capacity:
            rests.append((-(n % capacity), k, n - n % capacity))
    total = -sum(r[0] for r in rests)
    room = [capacity] * (total // capacity)
    left = total % capacity
    room += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    space, cost = np.array(room, np.int64), np.zeros(len(room))
    heapq.heapify(rests)
    while rests:
        negative, k, start = heapq.heappop(rests)
        length = -negative
        open_ = space >= length
        if not open_.any():
            open_ = space > 0
        at = int(np.where(open_, cost, np.inf).argmin())
        part = min(length, int(space[at]))
        out.append((k, start, part, sequence + at))
        space[at] -= part
        cost[at] += linear * part + quadratic * part * part
        if part < length:
            heapq.heappush(rests, (part - length, k, start + part))
    return out


def _pack(run: list[tuple[int | None, np.ndarray]], base: int, capacity: int, linear: float, quadratic: float) -> Iterator[pa.RecordBatch]:
    """The pieces of one run by sequence, in batches of at most ``BATCH``; sequences are numbered from ``base`` on."""
    pieces = assign([len(ids) for _, ids in run], capacity, linear, quadratic)
    used: dict[int, int] = {}
    cost: dict[int, float] = {}
    for _, _, n, s in pieces:
        used[s] = used.get(s, 0) + n
        cost[s] = cost.get(s, 0.0) + linear * n + quadratic * n * n
    at = dict.fromkeys(used, 0)
    pieces.sort(key=lambda p: (p[3], p[0], p[1]))
    types = [pa.int64()] * 7 + [pa.float64(), pa.binary()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for i in range(0, len(pieces), BATCH):
        columns: list[list] = [[] for _ in range(9)]
        for k, start, n, s in pieces[i:i + BATCH]:
            doc_id, ids = run[k]
            for column, value in zip(columns, (doc_id, start, n, len(ids), base + s, at[s], used[s], cost[s],
                                               ids[start:start + n].tobytes())):
                column.append(value)
            at[s] += n
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def pack(docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE_TOKENS, linear: float = LINEAR,
         quadratic: float = QUADRATIC, end_id: int = tokens.END_ID, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """One row per piece of a document: its place in the document and in its sequence, and its ids (uint32, little-endian)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        held, size = [], 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for lo, hi, data, offsets in text_blocks(batch.column(1), tokens.TOKEN_BLOCK):
                ids, begin = encode.block(data, offsets, end_id)
                ids = ids.astype("<u4", copy=False)
                held += [(doc_ids[lo + i], ids[begin[i]:begin[i + 1]]) for i in range(hi - lo)]
                size += len(ids)
                if size >= pack_tokens:
                    yield from _pack(held, base, capacity, linear, quadratic)
                    base, held, size = base + sequences(size, capacity), [], 0
        yield from _pack(held, base, capacity, linear, quadratic)
        release()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
