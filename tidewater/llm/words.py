"""Words of Arrow text batches as numpy arrays, without a Python loop per word.

A :class:`Scanner` reads the UTF-8 bytes of a batch piece by piece. A table of
256 entries maps each byte to 0 (separator) or to the byte that counts (A-Z
lower-cased). A word's hash is its slice of a polynomial prefix sum modulo
2**64, shifted back to position 0 and mixed with the word's length, so all
words of a piece are hashed by a handful of array operations. Two words count
as equal when their 64-bit hashes are equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20           # bytes of text handled at once (one document at least)
MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def mix(x):
    """splitmix64 finaliser on uint64 arrays: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int = 0):
    """``n`` fixed pseudo-random odd uint64 numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 20))
                   * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def lowered(separators) -> np.ndarray:
    """Byte table: A-Z to a-z, bytes for which ``separators(byte)`` holds to 0."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for b in range(256):
        if separators(b):
            t[b] = 0
    return t


def alnum_table() -> np.ndarray:
    """Words of 0-9, a-z and every non-ASCII character."""
    return lowered(lambda b: b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F)


def space_table() -> np.ndarray:
    """Words between ASCII white space (0x20, 0x09-0x0D)."""
    return lowered(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return offsets, data


def pieces(column, limit: int = PIECE_BYTES):
    """Yield (first row, last row + 1, offsets from 0, bytes) of at most ``limit`` bytes, one row at least."""
    offsets, data = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, offsets[lo:hi + 1] - offsets[lo], data[offsets[lo]:offsets[hi]]
        lo = hi


class Words:
    """Words of one piece: byte spans, hashes, and per document the range of its words."""

    __slots__ = ("start", "end", "hash", "first", "low")

    def __init__(self, start, end, hashes, first, low):
        self.start, self.end, self.hash, self.first, self.low = start, end, hashes, first, low


class Scanner:
    """Splits pieces into words and hashes them; keeps its power tables between pieces."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.value = seeds(256, 7)
        self._grow(PIECE_BYTES)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            inverse = pow(MULTIPLIER, -1, 1 << 64)
            self.power = np.cumprod(np.full(n + 1, MULTIPLIER, dtype=np.uint64), dtype=np.uint64)
            self.inverse = np.cumprod(np.full(n + 1, inverse, dtype=np.uint64), dtype=np.uint64)

    def spans(self, offsets, low):
        word = low != 0
        n = len(word)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = False
            before[1:] = word[:-1]
            after[:-1] = word[1:]
            cuts = offsets[1:-1]
            before[cuts[cuts < n]] = False
            last = cuts - 1
            after[last[last >= 0]] = False
        return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1

    def prefix(self, low):
        """Prefix sums P with hash(low[s:e]) = (P[e] - P[s]) shifted by inverse[s]."""
        n = len(low)
        if n >= len(self.power):
            self._grow(n)
        with np.errstate(over="ignore"):
            p = np.empty(n + 1, np.uint64)
            p[0] = 0
            np.cumsum(self.value[low] * self.power[:n], out=p[1:])
        return p

    def span_hash(self, p, start, end):
        with np.errstate(over="ignore"):
            return mix((p[end] - p[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def scan(self, offsets, data) -> Words:
        low = self.table[data]
        start, end = self.spans(offsets, low)
        return Words(start, end, self.span_hash(self.prefix(low), start, end),
                     np.searchsorted(start, offsets), low)
