"""Per-column statistical outliers and per-group pattern anomalies."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.flags import any_flag, beyond
from ..schema import q, require_columns, require_list
from .aggregate import join_group_stats
from .quantiles import as_number, iqr_bounds, median_and_mad

# Default thresholds: quartile fences, z-score, and the published 3.5 for the modified z-score.
THRESHOLDS = {"iqr": 1.5, "zscore": 3.0, "modified_zscore": 3.5}
MODIFIED_Z_SCALE = 0.6745


def statistical_outliers(
    df: DataFrame, columns: list[str], method: str = "iqr", threshold: float | None = None, quantiles: str = "exact"
) -> DataFrame:
    """Add ``{column}_outlier`` per present column and their union ``is_outlier``.

    All columns share the passes that find the bounds; the flags themselves are
    comparisons with literals, without shuffle.
    Missing values are never outliers.
    """
    columns = require_list(columns, "columns")
    if method not in THRESHOLDS:
        raise ValueError(f"unknown outlier method {method!r}")
    limit = THRESHOLDS[method] if threshold is None else threshold
    present = [c for c in columns if c in df.columns]
    tests = {}
    if present:
        find = {"iqr": _iqr, "zscore": _zscore, "modified_zscore": _modified_zscore}[method]
        tests = find(df, present, limit, quantiles)
    flagged = df.withColumns({f"{c}_outlier": F.coalesce(t, F.lit(False)) for c, t in tests.items()}) if tests else df
    return with_is_outlier(flagged)


def with_is_outlier(df: DataFrame) -> DataFrame:
    """OR of every ``*_outlier`` column, the union itself left out."""
    parts = [c for c in df.columns if c.endswith("_outlier") and c != "is_outlier"]
    return df.withColumn("is_outlier", any_flag(parts))


def outliers_iqr(df, columns, threshold: float = 1.5, quantiles: str = "exact") -> DataFrame:
    return statistical_outliers(df, columns, "iqr", threshold, quantiles)


def outliers_zscore(df, columns, threshold: float = 3.0) -> DataFrame:
    return statistical_outliers(df, columns, "zscore", threshold)


def outliers_modified_zscore(df, columns, threshold: float = 3.5, quantiles: str = "exact") -> DataFrame:
    return statistical_outliers(df, columns, "modified_zscore", threshold, quantiles)


def _iqr(df, columns, limit, quantiles) -> dict[str, Column]:
    bounds = iqr_bounds(df, columns, limit, quantiles)
    def outside(column: str, low: float, high: float) -> Column:
        # infinite values can make a bound not-a-number, which nothing is beyond
        below = F.lit(False) if math.isnan(low) else as_number(df, column) < F.lit(low)
        return below if math.isnan(high) else below | (as_number(df, column) > F.lit(high))

    return {c: outside(c, b[3], b[4]) if b else F.lit(False) for c, b in bounds.items()}


def _zscore(df, columns, limit, _) -> dict[str, Column]:
    moments = df.agg(*[
        F.struct(
            F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.min(x) < F.max(x)).alias("varied"),
        ).alias(f"x{i}")
        for i, x in enumerate(as_number(df, c) for c in columns)
    ]).first()
    tests = {}
    for i, c in enumerate(columns):
        found = moments[f"x{i}"]
        # a constant's rounded mean must not flag anything, nor a spread that is infinite or rounds to zero
        if found["varied"] and found["std"] > 0 and math.isfinite(found["std"]) and math.isfinite(found["mean"]):
            tests[c] = F.abs((as_number(df, c) - F.lit(found["mean"])) / F.lit(found["std"])) > F.lit(float(limit))
        else:
            tests[c] = F.lit(False)
    return tests


def _modified_zscore(df, columns, limit, quantiles) -> dict[str, Column]:
    tests = {}
    for c, (median, mad) in median_and_mad(df, columns, quantiles).items():
        x = as_number(df, c)
        if median is None or not (math.isfinite(median) and math.isfinite(mad)):
            tests[c] = F.lit(False)
        elif mad == 0:  # division by zero: infinitely far unless equal
            tests[c] = x != F.lit(median)
        else:
            tests[c] = F.abs(F.lit(MODIFIED_Z_SCALE) * (x - F.lit(median)) / F.lit(mad)) > F.lit(float(limit))
    return tests


def pattern_anomaly(
    df: DataFrame, group_columns: list[str], value_column: str, factor: float = 2.0
) -> DataFrame:
    """Flag values beyond two sample deviations of their group's mean.

    Adds the group statistics and ``pattern_anomaly``.  Rows missing a group key
    drop out, and a constant group flags nothing.
    """
    keys = require_list(group_columns, "group_columns")
    require_columns(df, [*keys, value_column])
    joined = join_group_stats(df, keys, value_column, extremes=True)
    name = lambda c: q(f"{c}_group" if c in df.columns else c)
    value = F.col(q(value_column))
    varied = F.col(name("min")) < F.col(name("max"))
    test = varied & beyond(value, F.col(name("mean")), F.col(name("std")), factor)
    flagged = joined.withColumn("pattern_anomaly", F.coalesce(test, F.lit(False)))
    return flagged.drop(*[f"{c}_group" if c in df.columns else c for c in ("min", "max")])
