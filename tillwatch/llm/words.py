"""Words of a batch of texts as arrays: places, 64-bit hashes, n-grams.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  A batch is cut into pieces of about ``PIECE`` bytes
(a longer text is a piece of its own), so memory follows the longest text and
not the batch.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
TEXTS = 2048  # texts of a piece, at most
BASE = 0x9E3779B97F4A7C15  # odd, 5 modulo 8: its powers repeat only after 2**62 steps
MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # glibc


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 1)
        for key, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


class Words:
    """Words of a few texts: ``start``, ``end`` (bytes) and ``doc`` (row) of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        self.texts = len(offsets) - 1
        blank = SPACE[self.data]
        first = ~blank
        last = first.copy()
        first[1:] &= blank[:-1]
        last[:-1] &= blank[1:]
        edge = offsets[1:-1]
        inner = edge[(edge > 0) & (edge < len(data))]
        first[inner] |= ~blank[inner]
        last[inner - 1] |= ~blank[inner - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.count = np.diff(np.searchsorted(self.start, offsets))
        self.doc = np.repeat(np.arange(self.texts), self.count)
        self._sums: np.ndarray | None = None

    def bounds(self) -> np.ndarray:
        """Where each text's words begin in the word arrays, and the end."""
        return np.concatenate(([0], np.cumsum(self.count)))

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges: equal for equal bytes."""
        up, down = _power(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            values = self.data.astype(np.uint64)
            values += np.uint64(1)
            values *= up[:len(values)]
            np.cumsum(values, out=self._sums[1:])
        out = (self._sums[end] - self._sums[start]) * down[start]
        return mix(out + (end - start).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.range_hash(self.start, self.end)


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one text, and their first words' places."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(3) + hashes[j:j + n])
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return out[at], at


def release() -> None:
    """Give freed memory back to the system: a worker outlives its task and shares an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def pieces(batch: pa.RecordBatch, column: str, lower: bool = False, size: int = PIECE) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of a batch, about ``size`` bytes each, with their words."""
    data, offsets = utf8(batch.column(column))
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, min(at + TEXTS, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1))
        part = offsets[at:to + 1]
        yield at, to, Words(data[part[0]:part[-1]], part - part[0], lower)
        at = to
    release()


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint."""
    return values.view(np.int64)
