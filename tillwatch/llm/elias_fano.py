"""Elias-Fano coding of a non-decreasing sequence of unsigned integers."""

from __future__ import annotations

import struct

import numpy as np


def encode(values: np.ndarray) -> bytes:
    """Low bits side by side, high bits as a bitmap in which the i-th one stands at high(i) + i."""
    n = len(values)
    values = values.astype(np.uint64)
    top = int(values[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if low <= 8 else None
    if bits is None:  # whole bytes, then the rest
        whole, rest = divmod(low, 8)
        raw = values.astype("<u8").view(np.uint8).reshape(n, 8)
        head = np.ascontiguousarray(raw[:, :whole]).tobytes()
        left = (values >> np.uint64(8 * whole))
        tail = np.packbits(((left[:, None] >> np.arange(rest, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)).tobytes()
    else:
        head, tail = b"", np.packbits(bits).tobytes()
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    marks = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    marks[high] = 1
    packed = np.packbits(marks).tobytes()
    return struct.pack("<QIQQQ", n, low, len(head), len(tail), len(packed)) + head + tail + packed


def decode(raw: bytes | memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    """The values that begin at a byte, and where the next thing begins."""
    n, low, head, tail, packed = struct.unpack_from("<QIQQQ", raw, at)
    at += struct.calcsize("<QIQQQ")
    whole, rest = divmod(low, 8) if low > 8 else (0, low)
    out = np.zeros(n, np.uint64)
    if head:
        bytes_ = np.zeros((n, 8), np.uint8)
        bytes_[:, :whole] = np.frombuffer(raw, np.uint8, head, at).reshape(n, whole)
        out = bytes_.view("<u8").ravel().astype(np.uint64)
    at += head
    if rest:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, tail, at), count=n * rest).reshape(n, rest)
        for i in range(rest):
            out |= bits[:, i].astype(np.uint64) << np.uint64(8 * whole + i)
    at += tail
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, packed, at)))
    out |= (ones - np.arange(n)).astype(np.uint64) << np.uint64(low)
    return out, at + packed
