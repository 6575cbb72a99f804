"""Vectorised text primitives shared by the corpus operators.

Everything here works on Arrow string columns inside a Python worker: a batch's
UTF-8 bytes are looked at through numpy, a few megabytes at a time, so that no
Python object is made per word.  Words are maximal runs of bytes outside
``[\\x20\\x09-\\x0D]``; as those bytes never occur inside a multi-byte UTF-8
sequence, byte runs and code-point runs are the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes looked at together; temporaries are about forty times this.  Of a longer text,
#: which stands alone, they are about ten times its bytes.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a span up to which spans are hashed together; longer ones one by one.
_TOGETHER = 128
#: Sums over words are taken modulo this prime with two bases.
PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_203_879_341, 1_784_560_207)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets (length + 1); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``limit`` bytes; a longer text stands alone."""
    limit = CHUNK_BYTES if limit is None else limit
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def pieces(offsets: np.ndarray, overlap: int, limit: int | None = None) -> Iterator[tuple[int, int, int, int]]:
    """Row ranges and byte ranges of about ``limit`` bytes.  A longer text comes in
    several pieces of one row, each ``overlap`` bytes into the next."""
    limit = CHUNK_BYTES if limit is None else limit
    for lo, hi in chunks(offsets, limit):
        a, z = int(offsets[lo]), int(offsets[hi])
        while hi == lo + 1 and z - a > limit + overlap:
            yield lo, hi, a, a + limit + overlap
            a += limit
        yield lo, hi, a, z


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def octets(data: np.ndarray) -> np.ndarray:
    """At each byte, and one past the last, that byte and the seven after it as one
    number; zeros follow the end.  A view of a padded copy, eight bytes more."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, the same wherever the bytes stand: eight
    bytes at a time are mixed into what those before them gave."""
    size = end - start
    h = size.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    if not len(h):
        return h
    word, at = octets(data), np.flatnonzero(size <= _TOGETHER)
    done = 0
    while len(at):
        h[at] = mix(h[at] ^ (word[start[at] + done] & _MASK[np.minimum(size[at] - done, 8)]))
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(size > _TOGETHER).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return h


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, up to ``most``."""
    word, n = octets(data), np.zeros(len(a), np.int64)
    limit = np.minimum(most, len(data) - np.maximum(a, b))
    at = np.flatnonzero(limit > 0)
    while len(at):
        differ = word[a[at] + n[at]] ^ word[b[at] + n[at]]
        # the lowest byte that is not zero is the first that differs
        same = np.where(differ == 0, 8, 0)
        for k in range(7, 0, -1):
            same = np.where((same == 0) & ((differ & _MASK[k]) == 0), k, same)
        n[at] += same
        at = at[(same == 8) & (n[at] < limit[at])]
    return np.minimum(n, limit)


def residue(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return x - PRIME * (x >= PRIME)


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0..n of each base and of its inverse."""
    global _powers
    if not _powers or len(_powers[0][0]) <= n:
        out = []
        for base in _BASES:
            pair = []
            for b in (base, pow(base, -1, int(PRIME))):
                p = np.ones(1, np.uint64)
                while len(p) <= n:
                    p = np.concatenate([p, residue(p * np.uint64(pow(b, len(p), int(PRIME))))])
                pair.append(p)
            out.append(tuple(pair))
        _powers = out
    return _powers


class Sums:
    """Hashes of ranges of hashed words: polynomials modulo a prime with two bases.

    Powers are counted from ``origin``, the place of a word in its line, so that the
    tables are as long as the longest line.  A range may not cross lines."""

    def __init__(self, words: np.ndarray, origin: np.ndarray):
        self.origin = origin
        self.powers = powers(int(origin.max(initial=0)) + 1)
        self.prefix = []
        for k, (up, _) in enumerate(self.powers):
            w = residue(words >> np.uint64(31 * k))
            self.prefix.append(np.append(np.uint64(0), np.cumsum(residue(w * up[origin]))))

    def raw(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        # an empty range may begin past the last word
        place = self.origin[np.minimum(a, len(self.origin) - 1)] if len(self.origin) else np.zeros(len(a), np.int64)
        return [residue(residue(p[b] - p[a]) * down[np.where(a < b, place, 0)]) for p, (_, down) in zip(self.prefix, self.powers)]

    def then(self, x: list[np.ndarray], y: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
        """The range ``y`` set behind ``x``, which has ``n`` words."""
        return [residue(u + residue(v * up[n])) for u, v, (up, _) in zip(x, y, self.powers)]

    @staticmethod
    def packed(x: list[np.ndarray], n: np.ndarray) -> np.ndarray:
        """One 64-bit hash of a range of ``n`` words."""
        return mix((x[0] | x[1] << np.uint64(31)) ^ mix(n.astype(np.uint64)))


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the first word's index
    (length + 1).  ``offsets`` starts at 0 and ends at len(data); ``between`` tells
    which bytes are outside words."""
    word = ~between[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    left = np.empty(len(data), bool)
    if len(data):
        left[0] = False
        left[1:] = word[:-1]
    starts = np.flatnonzero(word & (~left | first[:-1]))
    right = np.empty(len(data), bool)
    if len(data):
        right[-1] = False
        right[:-1] = word[1:]
    ends = np.flatnonzero(word & (~right | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word (length + 1)."""
    starts, ends, first = word_spans(data, offsets, between)
    return hash_spans(data, starts, ends), first
