"""A fixed-size bitmap of hashed keys, to leave most rows out of a shuffle.

The bitmap has 2**25 bits (4 MB) whatever the data.  A row that it lets through
may still have no partner, a row that it keeps back has none; with very many
keys it lets more rows through and changes nothing else.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


BITS = 25


def bitmap(keys: DataFrame, column: str = "key") -> np.ndarray:
    """Bits of the bigint keys of a table; at most 2**19 rows come to the driver."""
    place = F.shiftrightunsigned(_mixed(F.col(column)), 64 - BITS)
    bits = (keys.select(place.alias("place")).groupBy((F.shiftright("place", 6)).cast("int").alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63).cast("int"))).alias("bits"))
            .toArrow())
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return out.view(np.uint64)


def _mixed(key: Column) -> Column:
    return F.xxhash64(key)


def place_of(keys: np.ndarray) -> np.ndarray:
    """The bitmap's place of 64-bit keys, as the table's expression finds it."""
    return (xxhash_long(keys) >> np.uint64(64 - BITS)).astype(np.int64)


def let_through(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = place_of(keys)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def xxhash_long(keys: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of bigint values (seed 42): the published XXH64 of eight bytes."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turn(x, n):
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    k = keys.astype(np.uint64) if keys.dtype != np.int64 else keys.view(np.uint64)
    h = np.full(len(k), 42, np.uint64) + p5 + np.uint64(8)
    h = turn(h ^ turn(k * p2, 31) * p1, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))
