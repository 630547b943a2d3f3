"""Words of many texts at once, as flat numpy arrays over the UTF-8 bytes of an Arrow column.

A batch of texts is walked in pieces of about a megabyte (a longer text is a piece of its own), so
temporary arrays stay in cache and memory does not depend on the batch. Nothing here loops over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_GRAM = 0xD6E8FEB86659FD93 | 1
_SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def byte_table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


SPACE_WORD = ~byte_table(_SPACE_BYTES)
"""Bytes of the words ``[^\\x20\\x09-\\x0D]+`` (every byte above 0x7F belongs to a word)."""


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, dtype=U64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, min(2 * len(self.up), 1 << 22), 1 << 16)
            self.up, self.down = self._table(self.base, size), self._table(self.inverse, size)
        return self.up[:n], self.down[:n]


@lru_cache(maxsize=None)
def _powers(base: int) -> _Powers:
    return _Powers(base)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def prefix(values: np.ndarray, dtype=np.int64) -> np.ndarray:
    """0 followed by the running sums."""
    out = np.zeros(len(values) + 1, dtype=dtype)
    np.cumsum(values, dtype=dtype, out=out[1:])
    return out


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _GRAM) -> np.ndarray:
    """Polynomial hash of values[start:end] of each range, independent of its place."""
    up, down = _powers(base).upto(len(values) + 1)
    sums = prefix(values * up[: len(values)], U64)
    return (sums[end] - sums[start]) * down[start]


class Piece:
    """Some texts: ``data`` their bytes, ``edges`` the byte offsets of each text (n + 1)."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, rows: slice):
        self.data, self.edges, self.rows = data, edges, rows
        self.n = len(edges) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        return np.diff(prefix(flags)[self.edges])

    def count(self, table: np.ndarray) -> np.ndarray:
        """Bytes of a class in each text."""
        return self.per_text(table[self.data])

    def hash_ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each range."""
        values = self.data.astype(U64) + U64(1)
        return mix(range_hashes(values, start, end, _BASE) + (end - start).astype(U64))

    def words(self, table: np.ndarray = SPACE_WORD) -> Words:
        """Maximal runs of bytes of ``table`` inside each text."""
        inside = table[self.data]
        before = np.empty_like(inside)
        after = np.empty_like(inside)
        if len(inside):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            before[self.edges[:-1][self.edges[:-1] < len(inside)]] = False
            ends = self.edges[1:]
            after[ends[ends > 0] - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        return Words(self, start, end)


class Words:
    """``start``/``end`` byte places of the words, ``first`` the word offsets of each text (n + 1)."""

    def __init__(self, piece: Piece, start: np.ndarray, end: np.ndarray):
        self.piece, self.start, self.end = piece, start, end
        self.first = np.searchsorted(start, piece.edges)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(self.piece.n), self.counts)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        sums = prefix(values, values.dtype if values.dtype.kind == "f" else np.int64)
        return np.diff(sums[self.first])

    def hashes(self) -> np.ndarray:
        return self.piece.hash_ranges(self.start, self.end)

    def gram_starts(self, k: int) -> np.ndarray:
        """Words at which k consecutive words of one text start."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return np.flatnonzero(left >= k)


def gram_hashes(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k word hashes from each start."""
    return mix(range_hashes(hashes, starts, starts + k) + U64(k))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Flags of the n places that lie in some range [start, start + k)."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    steps[k:] -= np.bincount(starts + k, minlength=n + 1)[k : n + 1]
    return np.cumsum(steps[:n]) > 0


def pieces(column: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
    """Consecutive pieces of a text column; a null text is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        stop = int(np.searchsorted(edges, edges[at] + piece_bytes, side="right")) - 1
        stop = min(max(stop, at + 1), n)
        yield Piece(raw[edges[at] : edges[stop]], edges[at : stop + 1] - edges[at], slice(at, stop))
        at = stop
    _give_back()


@lru_cache(maxsize=1)
def _trim():
    """glibc's malloc_trim, where there is one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda keep: 0


def _give_back() -> None:
    """Return freed memory to the system: workers live on, and their heaps would only grow."""
    pa.default_memory_pool().release_unused()
    _trim()(0)
