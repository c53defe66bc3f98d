"""Runs of periodic words by grammar compression (operator 13).

A run is a stretch of words that repeats with smallest period q at least ``POWER`` times and
has at least ``LEAST`` words, and that no neighbouring word extends. Within a task, many
texts at a time (numpy):

1. Words become ids per text. A word of a run occurs ``POWER`` times or more in its text, so
   rarer words cut the text; stretches below ``LEAST`` words hold no run.
2. Re-Pair: the most frequent pairs become nonterminals until no pair of a text occurs twice.
   A round takes every pair occurrence that is more frequent than those it overlaps (equal
   counts by a hash, equal symbols from the left); a pair keeps its nonterminal in later
   rounds. What remains of a stretch is closed by a balanced tree.
3. For each nonterminal once: the runs that cross the boundary of its two parts. A period q
   fits twice into the left or the right part, so q qualifies by equal words next to the
   boundary, and the lengths of common extensions (hashes and binary search, all
   nonterminals and periods at once) give the run within the nonterminal.
4. These are translated to all places where the nonterminal is derived; of each period only
   maximal intervals stay. The lowest nonterminal over a whole run gives it in full.

Equality of long stretches rests on two hashes modulo 31-bit primes, of words on 64 bits.

Defined cases: a null text has no words and no runs; texts of any length are handled whole;
repeated rows give repeated results; a null id is returned as null; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import words
from skuflow.llm.common import small_batches, text_blocks

LEAST, POWER = 6, 4
#: (nonterminal, period) candidates that one numpy pass holds.
CHUNK = 1 << 21
_PRIMES = (2147483647, 2147483629)
_BASES = (911382323, 972663749)
_TEXT = np.uint64(0xE7037ED1A0B428DB)


class _Stretches:
    """Hashes of all stretches of a sequence of ids."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.pw, self.total = [], []
        value = words.mix(ids.astype(np.uint64) + np.uint64(1))
        for p, base, shift in zip(_PRIMES, _BASES, (0, 33)):
            power = np.ones(1, np.int64)
            while len(power) <= max(len(ids), longest):
                power = np.concatenate([power, power * (int(power[-1]) * base % p) % p])
            total = np.zeros(len(ids) + 1, np.int64)
            np.cumsum((value >> np.uint64(shift)).astype(np.int64) % p * power[:len(ids)] % p if shift else
                      (value & np.uint64(0x7FFFFFFF)).astype(np.int64) % p * power[:len(ids)] % p, out=total[1:])
            self.pw.append(power)
            self.total.append(total)

    def same(self, i: np.ndarray, q: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether the t ids from i on equal those from i + q on."""
        out = np.ones(len(i), bool)
        for p, power, total in zip(_PRIMES, self.pw, self.total):
            near, far = (total[i + t] - total[i]) % p, (total[i + q + t] - total[i + q]) % p
            out &= near * power[q] % p == far
        return out

    def forward(self, i: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many ids from i on equal those q further, ``most`` at most."""
        return self._search(lambda t: self.same(i, q, t), most)

    def backward(self, i: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many ids before i equal those q further, ``most`` at most."""
        return self._search(lambda t: self.same(i - t, q, t), most)

    @staticmethod
    def _search(holds, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        for _ in range(int(most.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def re_pair(symbol: np.ndarray, start: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All derivations of nonterminals: nonterminal, start, boundary and end of each, for one-word symbols at ``start``.

    ``stretch`` names the sequence a symbol lies in; symbols of different sequences differ.
    """
    end = start + 1
    fresh = int(symbol.max(initial=-1)) + 1
    known, named = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found: list[tuple] = []
    while len(symbol) > 1:
        key = symbol[:-1] << np.int64(31) | symbol[1:]
        whole = stretch[:-1] == stretch[1:]
        twin = whole & (symbol[:-1] == symbol[1:])
        odd = np.zeros(len(key), bool)                                  # of equal symbols in a row, every other pair
        if twin.any():
            opens = twin.copy()
            opens[1:] &= ~twin[:-1]
            at = np.flatnonzero(twin)
            first = np.maximum.accumulate(np.where(opens, np.arange(len(key)), 0))
            odd[at] = (at - first[at]) % 2 == 1
        place = np.flatnonzero(whole & ~odd)
        distinct, of, count = np.unique(key[place], return_inverse=True, return_counts=True)
        often = count[of] > 1
        if not often.any():
            break
        rank = np.zeros(len(key) + 2, np.int64)                         # one entry before and after
        tie = (words.mix(distinct.view(np.uint64)) >> np.uint64(32)).astype(np.int64)
        rank[place[often] + 1] = (np.minimum(count, (1 << 30) - 1) << 32 | tie)[of[often]] + 1
        taken = np.flatnonzero((rank[1:-1] > rank[:-2]) & (rank[1:-1] >= rank[2:]))
        pairs = np.unique(key[taken])
        new = pairs[~np.isin(pairs, known, assume_unique=True)]
        known, named = np.concatenate([known, new]), np.concatenate([named, fresh + np.arange(len(new))])
        order = np.argsort(known)
        known, named = known[order], named[order]
        fresh += len(new)
        name = named[np.searchsorted(known, key[taken])]
        found.append((name, start[taken], end[taken], end[taken + 1]))
        symbol, end = symbol.copy(), end.copy()
        symbol[taken], end[taken] = name, end[taken + 1]
        keep = np.ones(len(symbol), bool)
        keep[taken + 1] = False
        symbol, start, end, stretch = symbol[keep], start[keep], end[keep], stretch[keep]
    while len(stretch) > 1:                                             # the rest: neighbours in a balanced tree
        opens = np.append(True, stretch[1:] != stretch[:-1])
        place = np.arange(len(stretch)) - np.maximum.accumulate(np.where(opens, np.arange(len(stretch)), 0))
        taken = np.flatnonzero((place[:-1] % 2 == 0) & (stretch[:-1] == stretch[1:]))
        if not len(taken):
            break
        found.append((fresh + np.arange(len(taken)), start[taken], end[taken], end[taken + 1]))
        fresh += len(taken)
        end = end.copy()
        end[taken] = end[taken + 1]
        keep = np.ones(len(stretch), bool)
        keep[taken + 1] = False
        start, end, stretch = start[keep], end[keep], stretch[keep]
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*found))


def _crossing(ids: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, least: int, power: int) -> list[np.ndarray]:
    """Runs over the boundaries of nonterminals: index of the nonterminal, first word, end, period."""
    stretches = _Stretches(ids, int((end - start).max(initial=0)))
    out: list[np.ndarray] = []
    half = power // 2
    for right in (True, False):
        most = np.minimum((end - mid if right else mid - start) // half, (end - start) // power)
        total = np.cumsum(most)
        lo = 0
        while lo < len(most):
            before = int(total[lo - 1]) if lo else 0
            hi = max(int(np.searchsorted(total, before + CHUNK, side="right")), lo + 1)
            size = most[lo:hi]
            of = np.repeat(np.arange(lo, hi), size)
            q = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + 1
            lo = hi
            m = mid[of]
            # the equal words nearest to the boundary, then those at the far end of the first period
            good = np.flatnonzero(ids[m] == ids[m + q] if right else ids[m - 1] == ids[m - 1 - q])
            of, q, m = of[good], q[good], m[good]
            good = np.flatnonzero(ids[m + q - 1] == ids[m + 2 * q - 1] if right else ids[m - q] == ids[m - 2 * q])
            of, q, m = of[good], q[good], m[good]
            if right:
                after = stretches.forward(m, q, end[of] - m - q)
                good = np.flatnonzero(after >= q * (half - 1))
                of, q, m, after = of[good], q[good], m[good], after[good]
                before_ = stretches.backward(m, q, m - start[of])
                first, stop, over = m - before_, m + q + after, before_ > 0
            else:
                before_ = stretches.backward(m - q, q, m - q - start[of])
                good = np.flatnonzero(before_ >= q * (half - 1))
                of, q, m, before_ = of[good], q[good], m[good], before_[good]
                after = stretches.forward(m - q, q, end[of] - m)
                first, stop, over = m - q - before_, m + after, after > 0
            over &= stop - first >= np.maximum(least, power * q)
            out.append(np.stack([of, first, stop, q])[:, over])
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def runs(ids: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """All runs (first word, end, smallest period) of the texts that start at the words ``first``, by first word, then period.

    ``ids`` of different texts differ.
    """
    none = np.zeros((3, 0), np.int64)
    n = len(ids)
    if n < least:
        return none
    often = np.bincount(ids)[ids] >= power
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    opens = often & (edge[:-1] | ~np.append(False, often[:-1]))
    begin = np.flatnonzero(opens)
    name = np.cumsum(opens) - 1
    size = np.bincount(name[often], minlength=len(begin))
    at = np.flatnonzero(often)
    at = at[size[name[at]] >= least]
    if not len(at):
        return none
    symbol, start, mid, end = re_pair(ids[at].astype(np.int64), at, name[at])
    order = np.argsort(symbol, kind="stable")
    symbol, start, mid, end = symbol[order], start[order], mid[order], end[order]
    head = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))  # one derivation of each nonterminal
    of, lo, hi, q = _crossing(ids, start[head], mid[head], end[head], least, power)
    if not len(of):
        return none
    order = np.lexsort((q, hi, lo, of))                                 # of one interval the smallest period
    of, lo, hi, q = of[order], lo[order], hi[order], q[order]
    same = (of[1:] == of[:-1]) & (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1])
    keep = np.append(True, ~same)
    of, lo, hi, q = of[keep], lo[keep], hi[keep], q[keep]
    uses = np.diff(np.append(head, len(symbol)))[of]                    # to all derivations
    row = np.repeat(np.arange(len(of)), uses)
    use = head[of][row] + np.arange(len(row)) - np.repeat(np.cumsum(uses) - uses, uses)
    shift = start[use] - start[head[of]][row]
    lo, hi, q = lo[row] + shift, hi[row] + shift, q[row]
    order = np.lexsort((-hi, lo, q))
    lo, hi, q = lo[order], hi[order], q[order]
    rank = np.cumsum(np.append(0, q[1:] != q[:-1]))
    reach = np.maximum.accumulate(rank * (n + 1) + hi)
    keep = np.append(True, (reach[1:] > reach[:-1]))                    # not within an earlier one of its period
    lo, hi, q = lo[keep], hi[keep], q[keep]
    order = np.lexsort((q, lo))
    return np.stack([lo[order], hi[order], q[order]])


def _block_runs(data: np.ndarray, offsets: np.ndarray, least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a block's texts, and the first word of each text."""
    start, end, first = words.spans(data, offsets, words.NOT_SPACE)
    if not len(start):
        return np.zeros((3, 0), np.int64), first
    text = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
    hashes = words.word_hashes(data, start, end, words.BYTE) + (end - start).astype(np.uint64)
    _, ids = np.unique(words.mix(hashes ^ words.mix(text * _TEXT)), return_inverse=True)
    return runs(ids.astype(np.int64), first, least, power), first


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed`` has the words, joined by one space, that no run holds after its first period.
    """
    small_batches(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                (begin, stop, q), first = _block_runs(data, offsets, least, power)
                cut = np.searchsorted(begin, first)
                raw = data.tobytes()
                n_words, found, kept = [], [], []
                for k in range(hi - lo):
                    split = raw[offsets[k]:offsets[k + 1]].split()
                    own = [(a - int(first[k]), b - a, p) for a, b, p in zip(*(x[cut[k]:cut[k + 1]].tolist() for x in (begin, stop, q)))]
                    if own:
                        drop = np.zeros(len(split), bool)
                        for a, length, p in own:
                            drop[a + p:a + length] = True
                        kept.append(b" ".join(split[i] for i in np.flatnonzero(~drop).tolist()))
                    else:
                        kept.append(b" ".join(split))
                    n_words.append(len(split))
                    found.append([{"start": a, "length": length, "period": p} for a, length, p in own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n_words, pa.int64()), pa.array(found, run_type), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
