"""Duplicates and missing values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import column_type, is_numeric, normalize_missing, numeric_columns, q, require_columns
from ..session import materialize
from .ordered import interpolate
from .quantiles import column_quantiles, iqr_bounds

MISSING_MODES = ("drop", "fill", "interpolate", None)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Full-row distinct; missing equals missing.

    Copies are collapsed by the map-side half of the aggregate, so a group of
    copies of any size sends one row per map task through the shuffle.
    """
    return df.dropDuplicates()


def drop_missing(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def columns_with_missing(df: DataFrame, columns: list[str]) -> list[str]:
    """Which of the columns hold any missing value (one pass, scalars only)."""
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"]]


def fill_median(df: DataFrame, columns: list[str] | None = None, method: str = "exact") -> DataFrame:
    """Fill numeric columns with their median.

    Integer columns holding missing values become double first, as the median
    may be fractional.  All-missing columns stay as they are.
    """
    if columns is not None:
        require_columns(df, columns)
    chosen = [c for c in (columns or numeric_columns(df)) if is_numeric(column_type(df, c))]
    gaps = columns_with_missing(df, chosen)
    if not gaps:
        return df
    medians = {c: v[0] for c, v in column_quantiles(df, gaps, [0.5], method).items()}
    return df.withColumns({
        c: F.coalesce(F.col(q(c)).cast("double"), F.lit(medians[c]).cast("double")) for c in gaps})


def mode_value(df: DataFrame, column: str):
    """Most frequent value, the smallest one on ties, None if all are missing.

    Counts per value are combined map-side and spread over the shuffle by value,
    so high-cardinality columns need no single buffer of all values.
    """
    counts = df.filter(F.col(q(column)).isNotNull()).groupBy(F.col(q(column)).alias("v")).count()
    return counts.agg(F.min_by("v", F.struct(-F.col("count"), F.col("v")))).first()[0]


def fill_mode(df: DataFrame, columns: list[str] | None = None, default: str = "Unknown") -> DataFrame:
    """Fill non-numeric columns with their mode; string columns without one get ``default``."""
    if columns is not None:
        require_columns(df, columns)
    chosen = columns or [c for c in df.columns if not is_numeric(column_type(df, c))]
    filled: dict[str, Column] = {}
    for c in columns_with_missing(df, chosen):
        dtype = column_type(df, c)
        value = mode_value(df, c)
        if value is None and isinstance(dtype, T.StringType):
            value = default
        if value is not None:
            filled[c] = F.coalesce(F.col(q(c)), F.lit(value).cast(dtype))
    return df.withColumns(filled) if filled else df


def clean(
    df: DataFrame,
    remove_duplicates: bool = True,
    handle_missing: str | None = "drop",
    order_by: list | None = None,
    method: str = "exact",
    watch: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Duplicates first, then missing values by ``drop``, ``fill`` or ``interpolate``.

    ``watch`` may attach an observation to the rows after each step.
    """
    watch = watch or (lambda table, step: table)
    if handle_missing not in MISSING_MODES:
        raise ValueError(f"unknown handle_missing {handle_missing!r}")
    df = normalize_missing(df)
    if remove_duplicates:
        df = watch(drop_duplicates(df), "distinct")
    if handle_missing == "drop":
        return watch(drop_missing(df), "complete")
    if handle_missing == "fill":
        if remove_duplicates:
            df = materialize(df, "distinct")  # read by several passes below
        return fill_mode(fill_median(df, method=method))
    if handle_missing == "interpolate":
        return interpolate(df, order_by=order_by)
    return df


def remove_outliers_iqr(
    df: DataFrame, column: str = "money", threshold: float = 1.5, method: str = "exact"
) -> DataFrame:
    """Keep rows inside the quartile fences (inclusive); missing amounts go too."""
    if column not in df.columns:
        return df
    bounds = iqr_bounds(df, [column], threshold, method)[column]
    if bounds is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(q(column)).between(bounds[3], bounds[4]))
