"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(col: Column, fmt: str | None = None, strict: bool = True) -> Column:
    """Text to timestamp: raises on bad text when ``strict``, else gives null."""
    if strict:
        return F.to_timestamp(col, fmt) if fmt else F.to_timestamp(col)
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def to_day(col: Column) -> Column:
    return F.to_date(col)


def to_month(col: Column) -> Column:
    """Month period as the date of its first day."""
    return F.trunc(col, "month")


def month_label(col: Column) -> Column:
    """Month period as it is displayed."""
    return F.date_format(col, "yyyy-MM")


def format_date(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(col, fmt)


def day_name(col: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(col, "EEEE")
