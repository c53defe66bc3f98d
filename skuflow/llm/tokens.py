"""Token ids of whole texts by a ready-made word-level BPE of the ``tokenizers`` library.

The vocabulary's normalisation drops white space and its BPE never merges across
white space, nor between plain letters and other plain signs, so the ids of a
text are the ids of its pieces one after another. A piece is a run of letters or
of other signs; where a run of non-space signs has an apostrophe, ``<`` or signs
outside Latin-1 letters, the whole run is one piece. Texts are worked on in chunks
of bytes, cut before white space or between texts. Within a chunk the library encodes
each distinct piece once, and a worker keeps the ids of pieces it has met in a bounded
table; the rest is numpy lookups. Pieces are told apart by two independent 64-bit
hashes. tests/llm compare with encoding whole texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

from skuflow.llm import words

#: Pieces whose ids one worker keeps, at most so many ids apiece on average; further ones are encoded anew in each chunk that has them.
TABLE_SIZE, TABLE_IDS = 500_000, 8
#: Text bytes whose ids are returned together, and those that numpy handles at a time (its arrays take 32 to 48 times as much).
TOKEN_BLOCK, CHUNK = 2 << 20, 1 << 19
END_ID = 2
_encoders: dict[str, "TextEncoder"] = {}


def _signs(kind: str) -> str:
    return re.escape("".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == kind))


_LETTER, _DIGIT = _signs("L"), _signs("N")
_PART = re.compile(f"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")
_CHECK = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)


#: Signs by byte: 0 ASCII white space, 1 letters (ASCII, and the bytes of Latin-1 letters), 2 the rest.
_KIND = np.full(256, 2, np.uint8)
_KIND[~words.NOT_SPACE] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: Bytes that make their run one piece: apostrophe, "<", and lead bytes of other signs than Latin-1 letters.
_ODD = np.zeros(256, bool)
_ODD[[0x27, 0x3C, 0xC2, *range(0xC4, 256)]] = True


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each piece, the first piece of each text, and the bytes with plain letters in lower case."""
    start, end, first = words.spans(data, offsets, words.NOT_SPACE)
    if not len(start):
        return start, end, first, data
    odd = _ODD[data]
    sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))   # the signs for times and divided by
    odd[sign] = True
    hit = np.flatnonzero(odd)
    run = np.unique(np.searchsorted(start, hit, side="right") - 1)
    kind = _KIND[data]
    inner = (kind[1:] != kind[:-1]) & (kind[1:] != 0) & (kind[:-1] != 0)
    change = np.zeros(len(data) + 1, np.int8)
    change[start[run]] += 1
    np.subtract.at(change, end[run], 1)
    whole = np.cumsum(change, dtype=np.int8)[:-1].astype(bool)
    inner &= ~whole[1:]
    begins, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    begins[start], ends[end] = True, True
    at = np.flatnonzero(inner) + 1
    begins[at], ends[at] = True, True
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends), np.searchsorted(start, offsets), np.where(whole, data, words.LOWER[data])


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut texts into runs of at most ``limit`` bytes, before white space or between texts; a longer run of signs stays whole."""
    lo, n = 0, len(data)
    while lo < n:
        hi = n if lo + limit >= n else _cut(data, offsets, lo, lo + limit)
        yield lo, hi
        lo = hi


def _cut(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> int:
    """The last place after ``lo`` and up to ``hi`` where a cut may be, else the first one beyond."""
    limit = hi - lo
    space = np.flatnonzero(~words.NOT_SPACE[data[lo + 1:hi + 1]])
    at = max(int(offsets[np.searchsorted(offsets, hi, side="right") - 1]), lo + 1 + int(space[-1]) if len(space) else 0)
    if at > lo:
        return at
    edge = int(offsets[np.searchsorted(offsets, hi, side="right")])
    for begin in range(hi + 1, edge, limit):
        space = np.flatnonzero(~words.NOT_SPACE[data[begin:min(begin + limit, edge)]])
        if len(space):
            return begin + int(space[0])
    return edge


class TextEncoder:
    def __init__(self, path: str, table_size: int = TABLE_SIZE):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table_size = table_size
        self.keys = np.zeros(0, np.uint64)       # sorted first hashes of the table's pieces
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros((0, 2), np.int32)     # where a piece's ids lie in self.ids: start, length
        self.ids = np.zeros(0, np.uint32)

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece: part by part where its signs are plain, else by the library's whole pipeline."""
        if "<" in piece or not piece.isprintable() or not piece.isascii() and max(piece) > "\xff":
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        out = []
        for part in _PART.findall(piece.lower()):
            if not part.isascii():
                part = self.alphabet.pre_tokenize_str(part)[0][0]
            out += [t.id for t in self.tokenizer.model.tokenize(part)]
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray, end_id: int = END_ID, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block's texts (each with the end id) and where each text's ids begin."""
        texts = len(offsets) - 1
        sizes, parts = np.ones(texts, np.int64), [np.zeros(0, np.uint32)]
        for lo, hi in chunks(data, offsets, chunk):
            own = slice(np.searchsorted(offsets, lo, side="right") - 1, np.searchsorted(offsets, hi))
            ids, begin = self._ids(data[lo:hi], np.clip(offsets[own.start:own.stop + 1], lo, hi) - lo)
            sizes[own] += np.diff(begin)
            parts.append(ids)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(begin[-1], np.uint32)
        kept = np.ones(len(out), bool)
        kept[begin[1:] - 1] = False
        out[~kept] = end_id
        out[kept] = np.concatenate(parts)
        return out, begin

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts and where each text's ids begin."""
        start, end, first, data = _pieces(data, offsets)
        n = len(start)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        key = words.word_hashes(data, start, end, table=words.BYTE)
        check = words.word_hashes(data, start, end, table=_CHECK)
        low = np.uint64((1 << n.bit_length()) - 1)
        order = (np.sort(key & ~low | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
        ranked, seen = key[order], check[order]
        new = np.concatenate(([True], (ranked[1:] != ranked[:-1]) | (seen[1:] != seen[:-1])))
        one = order[new]
        at, flat = self._look_up(ranked[new], seen[new], data, start[one], end[one])
        group = np.empty(n, np.int64)
        group[order] = np.cumsum(new) - 1
        places, lengths = at[group, 0], at[group, 1]
        before = np.concatenate(([0], np.cumsum(lengths)))
        return flat[np.repeat(places - before[:-1], lengths) + np.arange(before[-1])], before[first]

    def _look_up(self, key, check, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Place and length of the ids of distinct pieces, and the array that holds them."""
        at = np.zeros((len(key), 2), np.int64)
        spot = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = (self.keys[spot] == key) & (self.checks[spot] == check) if len(self.keys) else np.zeros(len(key), bool)
        at[known] = self.at[spot[known]]
        miss = np.flatnonzero(~known)
        if not len(miss):
            return at, self.ids
        raw = data.tobytes()
        made = [self.piece(raw[s:e].decode("utf-8", "replace")) for s, e in zip(start[miss].tolist(), end[miss].tolist())]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        fresh = np.fromiter((i for ids in made for i in ids), np.uint32, int(sizes.sum()))
        at[miss, 0] = len(self.ids) + np.cumsum(sizes) - sizes
        at[miss, 1] = sizes
        flat = np.concatenate((self.ids, fresh))
        if len(self.keys) + len(miss) <= self.table_size and len(flat) <= TABLE_IDS * self.table_size:
            spot = np.searchsorted(self.keys, key[miss], side="right")
            self.keys = np.insert(self.keys, spot, key[miss])            # one array after the other: each is held twice for a moment
            self.checks = np.insert(self.checks, spot, check[miss])
            self.at = np.insert(self.at, spot, at[miss], axis=0)
            self.ids = flat
        return at, flat


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)
