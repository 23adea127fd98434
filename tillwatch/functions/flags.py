"""Boolean-flag expressions shared by the detectors and their reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import q


def flag_columns(df: DataFrame) -> list[str]:
    """Boolean columns whose name marks them as an anomaly or outlier flag."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.BooleanType) and ("anomaly" in f.name or "outlier" in f.name)
    ]


def any_flag(names: list[str]) -> Column:
    """Row-wise OR with missing counted as false; false for no columns."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(q(n)), F.lit(False)) for n in names], F.lit(False))


def share(count: Column, total: Column) -> Column:
    """Percent of ``total``, two decimals, half to even."""
    return F.bround(F.try_divide(count * F.lit(100.0), total), 2)


def beyond(value: Column, center: Column, spread: Column, factor: float) -> Column:
    """Strictly farther than ``factor`` spreads from the center."""
    return F.abs(value - center) > F.lit(float(factor)) * spread
