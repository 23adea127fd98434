"""Minimal perfect hashing of 64-bit keys by cascaded bit levels.

Each level maps the keys left over to ``1.6 x`` as many bits; a bit that exactly
one key hits is set and that key is placed, the others go on.  A key's slot is
the number of set bits before its own over all levels, so ``n`` keys get the
slots 0..n-1.  Keys that were not built in get some slot or none; a stored
fingerprint tells them apart.
"""

from __future__ import annotations

import struct

import numpy as np

from .words import mix

SPREAD = 1.6
LEVELS = 64


def _hit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


class Mph:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.concatenate(([0], np.cumsum([int(x.sum()) for x in levels]))).astype(np.int64)
        self.ranks = [np.concatenate(([0], np.cumsum(x))) for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> "Mph":
        levels: list[np.ndarray] = []
        while len(keys):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, int(len(keys) * SPREAD))
            at = _hit(keys, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            keys = keys[~bits[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = _hit(keys[left], level, len(bits))
            found = bits[at]
            out[left[found]] = self.before[level] + self.ranks[level][at[found]]
            left = left[~found]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + b"".join(struct.pack("<I", len(x)) for x in self.levels)
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple["Mph", int]:
        """The function and how many bytes it took."""
        n = struct.unpack_from("<I", raw)[0]
        sizes = struct.unpack_from(f"<{n}I", raw, 4)
        at = 4 + 4 * n
        levels = []
        for size in sizes:
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels), at
