"""Vectorised text helpers that run inside Spark tasks on Arrow columns.

Texts stay UTF-8 bytes.  A word is a run of bytes that a 256-entry table
maps to non-zero (the folded byte); its 64-bit hash is a polynomial over
the folded bytes, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once by one vector operation, which takes about 50 times
#: that for hashes and their places.
SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_pow = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0..n-1 modulo 2**64 (or of its inverse)."""
    have = _pow.get(inverse)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, _BASE_INV if inverse else _BASE, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _pow[inverse] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random 64-bit number for each byte value.
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[0] = 0: sum of BYTE_HASH[data[j]] * base**j up to i."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_HASH[data] * powers(len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of data[start:end]."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), True)[start] + (end - start).astype(np.uint64))


def ascii_space_table() -> np.ndarray:
    """Words [^\\x20\\x09-\\x0D]+, A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[[9, 10, 11, 12, 13, 32]] = 0
    return _keep_nul(t, True)


def alnum_table() -> np.ndarray:
    """Words of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased."""
    t = np.zeros(256, np.uint8)
    t[48:58] = np.arange(48, 58)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


def _keep_nul(t: np.ndarray, nul_is_word: bool) -> np.ndarray:
    # byte 0 is a word byte there; 0xFF never occurs in UTF-8 and stands for it
    if nul_is_word:
        t[0] = 0xFF
    return t


SPACE_WORDS = ascii_space_table()
ALNUM_WORDS = alnum_table()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``limit`` bytes (a longer one alone)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of a run of documents: hashes, byte spans, offsets by document."""

    __slots__ = ("hash", "start", "end", "by_doc")

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        folded = table[data]
        is_word = folded != 0
        first = np.zeros(len(data) + 1, bool)
        first[offs] = True  # a document's first byte begins a word
        edge = np.empty(len(data) + 1, bool)
        edge[0] = True
        edge[1:-1] = ~is_word[:-1]
        edge[-1] = True
        edge |= first
        self.start = np.flatnonzero(is_word & edge[:-1])
        after = np.ones(len(data), bool)
        after[:-1] = ~is_word[1:]
        after |= first[1:]
        self.end = np.flatnonzero(is_word & after) + 1
        self.hash = span_hash(prefix_hash(folded), self.start, self.end)
        self.by_doc = np.searchsorted(self.start, offs)


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out += hashes[j:j + n] * powers(k + 1)[j + 1]
    return mix(out)


def shingles(words: Words, k: int) -> Iterator[np.ndarray]:
    """For each document the sorted distinct k-word shingle hashes; fewer
    words make one shingle, no words none."""
    every = runs_of(words.hash, k)
    for a, b in zip(words.by_doc[:-1], words.by_doc[1:], strict=True):
        if b - a >= k:
            yield np.unique(every[a:b - k + 1])
        elif b > a:
            yield runs_of(words.hash[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def texts_of(batch: pa.RecordBatch, table: np.ndarray, column: str = "text") -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over runs of the batch's documents."""
    data, offs = utf8(batch.column(column))
    for i, j in slices(offs):
        own = offs[i:j + 1] - offs[i]
        yield i, j, Words(data[offs[i]:offs[j]], own, table)
