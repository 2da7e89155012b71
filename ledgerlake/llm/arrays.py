"""Texts of an Arrow batch as numpy arrays: byte offsets, words, rolling
hashes.  Everything is vectorised over a block of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)          # odd, so powers never vanish mod 2**64
_GRAM = U64(0xD6E8FEB86659FD93)
_powers = np.ones(1, U64)

#: Words `[^\x20\x09-\x0D]+`: the bytes that separate them.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, a-z
#: and every byte of a non-ASCII character.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base mod 2**64."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        grown = np.full(size, _BASE, U64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def blocks(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes (a longer text alone)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


class Words:
    """Maximal runs of bytes outside ``sep`` in each text of a block.

    start, end: byte positions in the block; doc: index of the text; hash:
    64-bit rolling hash of the bytes; chars: code points.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, sep: np.ndarray, want_chars: bool = False):
        size, n = len(data), len(off) - 1
        inside = ~sep[data]
        first = np.empty(size + 1, bool)         # a text or a separator ends before here
        first[1:] = ~np.append(inside, False)[:-1] if size else True
        first[:1] = True
        first[off] = True
        self.start = np.flatnonzero(inside & first[:-1])
        last = first[1:].copy()
        if size:
            last[:-1] |= ~inside[1:]
        self.end = np.flatnonzero(inside & last) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        lens = self.end - self.start
        self.first = np.searchsorted(self.doc, np.arange(n + 1))   # of each text, its first word
        if not len(lens):
            self.hash, self.chars = np.zeros(0, U64), np.zeros(0, np.int64)
            return
        held = data[inside]
        at = np.cumsum(lens) - lens
        pos = np.arange(len(held), dtype=np.int32) - np.repeat(at.astype(np.int32), lens)
        value = powers(int(lens.max()))[pos]
        value *= held.astype(U64) + U64(1)
        self.hash = mix(np.add.reduceat(value, at) + lens.astype(U64) * _GRAM)
        self.chars = np.add.reduceat(((held & 0xC0) != 0x80).astype(np.int64), at) if want_chars else None

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each window of ``n`` consecutive words."""
        if len(self.hash) < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        span = len(self.hash) - n + 1
        at = np.flatnonzero(self.doc[:span] == self.doc[n - 1:])
        return at, self.grams_at(at, n)

    def grams_at(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the windows of ``n`` words that begin at ``at``."""
        total = np.zeros(len(at), U64)
        for j in range(n):
            total = (total + self.hash[at + j]) * _GRAM
        return mix(total + U64(n))


def repeated(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (text, key): whether the pair occurs twice or more, and
    whether it occurred before (in order of position)."""
    if not len(key):
        return np.zeros(0, bool), np.zeros(0, bool)
    both = mix(key + doc.astype(U64) * _BASE)
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def per_text(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer ``values`` by text."""
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)
