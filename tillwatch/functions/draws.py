"""Random numbers that any engine with md5 draws alike."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unit(*parts: Column) -> Column:
    """A number from 0 to below 1, by the first eight hex digits of the md5 of the parts joined by colons."""
    text = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / float(1 << 32)
