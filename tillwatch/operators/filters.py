"""Row filters.  All of them are plain predicates, so they reach the scan."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import q


def range_predicate(name: str, low: Any, high: Any) -> Column:
    """Inclusive range; missing never matches."""
    return F.col(q(name)).between(low, high)


def in_predicate(name: str, values: list) -> Column:
    """Membership; a None in the list matches missing values."""
    present = [v for v in values if v is not None]
    test = F.col(q(name)).isin(present) if present else F.lit(False)
    return (test | F.col(q(name)).isNull()) if len(present) < len(values) else test


def eq_predicate(name: str, value: Any) -> Column:
    """Equality; comparing with None matches nothing."""
    return F.lit(False) if value is None else F.col(q(name)) == F.lit(value)


def predicate(name: str, value: Any) -> Column:
    if isinstance(value, tuple):
        if len(value) != 2:
            raise ValueError(f"range filter on {name} needs (min, max)")
        return range_predicate(name, *value)
    if isinstance(value, list):
        return in_predicate(name, value)
    return eq_predicate(name, value)


def filter_all(df: DataFrame, filters: dict[str, Any]) -> DataFrame:
    """Keep rows passing every entry: tuple = range, list = membership, else equality.

    Columns the table does not have are ignored.
    """
    tests = [predicate(name, value) for name, value in filters.items() if name in df.columns]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def filter_range(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    return filter_all(df, {column: (low, high)})


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return filter_all(df, {column: list(values)})


def filter_eq(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(eq_predicate(column, value)) if column in df.columns else df
