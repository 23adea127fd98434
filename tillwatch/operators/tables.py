"""Pivots, histograms, profiles and descriptive statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import month_label, to_month
from ..schema import column_type, is_numeric, numeric_columns, q, require_columns, require_list
from .aggregate import drop_null_keys
from .quantiles import as_number, column_quantiles


def pivot_values(df: DataFrame, index: str, columns: str) -> list:
    """Sorted distinct column labels, refused above ``spark.sql.pivotMaxValues``."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    labels = drop_null_keys(df, [index, columns]).select(F.col(q(columns)).alias("v")).distinct()
    found = [r["v"] for r in labels.orderBy("v").limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"pivot column {columns} has more than {limit} values")
    return found


def pivot_sum(
    df: DataFrame,
    index: str,
    columns: str,
    values: str,
    fill_value: float | None = 0,
    pivot_on: list | None = None,
    sort: bool = True,
) -> DataFrame:
    """Sums of ``values`` for index by column, empty cells filled, both sides sorted.

    Rows missing an index or column label are dropped.  The sum is taken per
    (index, label) with map-side combine before the pivot, so neither a hot
    index value nor a hot label gathers rows.  Pass ``pivot_on`` to save the
    scan for distinct labels.
    """
    require_columns(df, [index, columns, values])
    labels = pivot_on if pivot_on is not None else pivot_values(df, index, columns)
    total = F.coalesce(F.sum(q(values)), F.lit(0).cast(column_type(df, values)))
    result = drop_null_keys(df, [index, columns]).groupBy(q(index)).pivot(columns, labels).agg(total)
    if fill_value is not None:
        cells = [c for c in result.columns if c != index]
        result = result.select(q(index), *[
            F.coalesce(F.col(q(c)), F.lit(fill_value).cast(result.schema[c].dataType)).alias(c) for c in cells])
    return result.orderBy(q(index)) if sort else result


def pivot_map(df: DataFrame, index: str, columns: str, values: str, output: str = "cells") -> DataFrame:
    """``pivot_sum`` for any number of column labels: one map from label to sum for each index value.

    Labels are cells of a map instead of columns, so none has to be known before and no limit
    holds; ``cell`` reads one with its fill value, ``map_entries`` lists them.  Sums are taken
    per (index, label) map-side first, so a row of the result gathers its labels, never rows.
    """
    require_columns(df, [index, columns, values])
    total = F.coalesce(F.sum(q(values)), F.lit(0).cast(column_type(df, values)))
    sums = drop_null_keys(df, [index, columns]).groupBy(q(index), q(columns)).agg(total.alias("__sum"))
    cells = F.sort_array(F.collect_list(F.struct(F.col(q(columns)).alias("label"), F.col("__sum").alias("value"))))
    return sums.groupBy(q(index)).agg(F.map_from_entries(cells).alias(output))


def cell(cells: str, label, fill_value: float = 0) -> Column:
    """One cell of a ``pivot_map``, empty ones filled."""
    return F.coalesce(F.try_element_at(F.col(q(cells)), F.lit(label)), F.lit(fill_value))


def pivot_rows(df: DataFrame, index: str, cells: str = "cells", label: str = "label", value: str = "value") -> DataFrame:
    """Long form of a ``pivot_map``."""
    return df.select(q(index), F.explode(F.col(q(cells))).alias(label, value))


def unpivot(df: DataFrame, index: str, label: str = "column", value: str = "value") -> DataFrame:
    """Long form of a pivot table, for charts."""
    cells = [c for c in df.columns if c != index]
    return df.unpivot([q(index)], [q(c) for c in cells], label, value)


def product_month(df: DataFrame, product: str = "coffee_name", date: str = "Date", value: str = "money",
                  months: list[str] | None = None) -> DataFrame:
    """Product by month sums (the heat map's table); month columns are ``yyyy-MM``."""
    keyed = df.select(q(product), q(value), month_label(to_month(F.col(q(date)))).alias("__month"))
    return pivot_sum(keyed, product, "__month", value, 0, pivot_on=months)


def product_month_long(df: DataFrame, product: str = "coffee_name", date: str = "Date", value: str = "money",
                       fill: float = 0) -> DataFrame:
    """The heat map as rows (product, month, sales), every product with every month present.

    The months come to the driver (as many as the calendar has), not as columns, so
    any number of them goes.
    """
    month = month_label(to_month(F.col(q(date)))).alias("month")
    sums = df.filter(F.col(q(product)).isNotNull()).groupBy(q(product), month).agg(F.sum(q(value)).alias("sales"))
    months = sorted(r[0] for r in df.select(month).distinct().collect() if r[0] is not None)
    grid = df.filter(F.col(q(product)).isNotNull()).select(q(product)).distinct().select(
        q(product), F.explode(F.array(*[F.lit(m) for m in months]).cast("array<string>")).alias("month"))
    return grid.join(sums, [product, "month"], "left").select(
        q(product), "month", F.coalesce("sales", F.lit(float(fill))).alias("sales"))


def histogram(df: DataFrame, column: str = "money", bins: int = 30) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, the last bin closed.

    All bins appear, also empty ones.  If all values are equal the range is
    widened by a half on both sides.
    """
    require_columns(df, [column])
    if bins < 1:
        raise ValueError("bins must be at least 1")
    value = as_number(df, column)
    data = df.select(value.alias("x")).filter(F.col("x").isNotNull())
    low, high = data.agg(F.min("x"), F.max("x")).first()
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if low is None:
        nothing = F.lit(None).cast("double")
        return frame.select("bin", nothing.alias("bin_start"), nothing.alias("bin_end"), F.lit(0).cast("long").alias("count")).orderBy("bin")
    if not (math.isfinite(low) and math.isfinite(high)):
        raise ValueError(f"{column} holds an infinite value")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    edges = F.array(*[F.lit(low + i * width if i < bins else high) for i in range(bins + 1)])
    # the division may round a value over an edge: what counts is where the edges lie
    guess = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)).cast("int") + 1, F.lit(bins))
    placed = data.withColumn("bin", guess)
    number = (F.when(F.col("x") < F.element_at(edges, F.col("bin")), F.col("bin") - 1)
              .when((F.col("x") >= F.element_at(edges, F.col("bin") + 1)) & (F.col("bin") < bins), F.col("bin") + 1)
              .otherwise(F.col("bin")))
    counts = placed.groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        F.element_at(edges, F.col("bin")).alias("bin_start"),
        F.element_at(edges, F.col("bin") + 1).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("count"),
    ).orderBy("bin")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, missing count and row count, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(q(c)).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"n{i}").alias("null_count"), F.col("rows").alias("row_count"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: list[str] | None = None, method: str = "exact") -> DataFrame:
    """Count, mean, std, min, quartiles and max per numeric column, one row each."""
    chosen = require_list(columns, "columns") if columns is not None else numeric_columns(df)
    require_columns(df, chosen)
    chosen = [c for c in chosen if is_numeric(column_type(df, c))]
    quartiles = column_quantiles(df, chosen, [0.25, 0.5, 0.75], method)
    moments = df.agg(*[
        F.struct(
            F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(f"m{i}")
        for i, x in enumerate(as_number(df, c) for c in chosen)
    ])
    entries = []
    for i, c in enumerate(chosen):
        part = lambda name: F.col(f"m{i}").getField(name).alias(name)
        fixed = [F.lit(v).cast("double").alias(n) for n, v in zip(("q25", "median", "q75"), quartiles[c])]
        entries.append(F.struct(F.lit(c).alias("column"), part("count"), part("mean"), part("std"),
                                part("min"), *fixed, part("max")))
    return moments.select(F.inline(F.array(*entries)))


def long_form(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Turn a one-row table into (metric, value) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
        for name, value in metrics.items()])))
