"""Vectorised words, hashes and word windows over blocks of UTF-8 text (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20250101)
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTE = BYTE[LOWER]
#: Words of the contamination contract: letters A-Z, digits and everything outside ASCII.
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    ALNUM[_lo:_hi] = True
#: Words of the shingle contracts: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def powers(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size > 1 << 23:          # one very long text: don't keep its table
            return have
        _powers[kind] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (one entry more than texts)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    mask = in_word[data]
    edge = mask.copy()
    edge[1:] &= ~mask[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    edge[heads] = mask[heads]
    start = np.flatnonzero(edge)
    edge = mask
    last = edge.copy()
    last[:-1] &= ~mask[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = mask[tails]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = LOWER_BYTE) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``table`` gives the bytes' values (by default A-Z as a-z)."""
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(table[data] * powers("step", _STEP, len(data) + 1)[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * powers("back", _BACK, len(data) + 1)[start])


def gram_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they lie in one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total, factor = np.full(n, k, np.uint64), np.uint64(1)
    for j in range(k):
        total += words[j:j + n] * factor
        factor = np.uint64((int(factor) * int(_WORD_STEP)) & 0xFFFFFFFFFFFFFFFF)
    whole = np.ones(n, bool)
    for j in range(1, k):
        at = first[1:] - j
        whole[at[(at >= 0) & (at < n)]] = False
    return mix(total), whole


def winnow(grams: np.ndarray, whole: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least hash of some run of ``window`` consecutive grams.

    Equal text gives equal hashes, so two texts that share ``window`` grams in a
    row select the same one there. Grams that cross a text's end take part as
    the largest value; ties all stay.
    """
    n = len(grams)
    if n == 0:
        return np.zeros(0, np.int64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full(n + 2 * (window - 1), top, np.uint64)
    padded[window - 1:window - 1 + n] = np.where(whole, grams, top)
    low = _slide(padded, window, np.minimum)              # least of each run, runs past the ends too
    best = _slide(low, window, np.maximum)                # largest of those leasts over the runs with i
    return np.flatnonzero(whole & (best == grams))


def _slide(x: np.ndarray, width: int, fold: np.ufunc) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = fold(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return fold(x[:len(x) - rest], x[rest:]) if rest else x
