"""Derived columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.bins import SALES_EDGES, SALES_LABELS, bin_label, bin_ordinal
from ..functions.dates import day_name, parse_date
from ..schema import column_type, q, require_columns, require_list


def calendar_columns(df: DataFrame, date_column: str = "Date") -> DataFrame:
    """Add ``year, month, day_of_week, quarter`` when the date column exists."""
    if date_column not in df.columns:
        return df
    day = F.col(q(date_column))
    if isinstance(column_type(df, date_column), T.StringType):
        day = parse_date(day)
    return df.withColumns({
        "year": F.year(day),
        "month": F.month(day),
        "day_of_week": day_name(day),
        "quarter": F.quarter(day),
    })


def bin_column(df: DataFrame, column: str, edges: list[float], labels: list[str], output: str) -> DataFrame:
    """Add a label column and its ``_ord`` ordinal for right-closed bins."""
    value = F.col(q(column))
    return df.withColumns({
        output: bin_label(value, edges, labels),
        f"{output}_ord": bin_ordinal(value, edges, labels),
    })


def sales_category(df: DataFrame, column: str = "money") -> DataFrame:
    """Price band of each sale, when the amount column exists."""
    if column not in df.columns:
        return df
    return bin_column(df, column, SALES_EDGES, SALES_LABELS, "sales_category")


def add_calculated_columns(df: DataFrame) -> DataFrame:
    return sales_category(calendar_columns(df))


def standardize(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """Add ``(x - mean) / population std`` per feature.

    Statistics come from rows complete in all features, and rows that are not
    complete get null.  A constant feature, or one whose spread rounds to zero, is divided
    by one; one with an infinite value has no scale and gets null.  The moments
    come from one map-side combined aggregate.
    """
    columns = require_list(columns, "columns")
    require_columns(df, columns)
    complete = _complete(columns)
    moments = df.filter(complete).agg(*[
        F.struct(
            F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.min(x) == F.max(x)).alias("constant"),
        ).alias(f"x{i}")
        for i, x in enumerate(F.col(q(c)).cast("double") for c in columns)
    ]).first()
    scaled = {}
    for i, c in enumerate(columns):
        found = moments[f"x{i}"]
        if found["std"] is not None and not math.isfinite(found["std"]):
            scaled[f"{c}{suffix}"] = F.lit(None).cast("double")
            continue
        spread = 1.0 if found["constant"] or found["std"] == 0 else found["std"]
        centered = F.col(q(c)).cast("double") - F.lit(found["mean"]).cast("double")
        scaled[f"{c}{suffix}"] = F.when(complete, centered / F.lit(spread).cast("double"))
    return df.withColumns(scaled)


def _complete(columns: list[str]):
    test = F.lit(True)
    for c in columns:
        test = test & F.col(q(c)).isNotNull()
    return test
