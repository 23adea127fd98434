"""Canonical sales schema and the one missing marker every operator assumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SALES_SCHEMA = T.StructType([
    T.StructField("hour_of_day", T.LongType()),
    T.StructField("cash_type", T.StringType()),
    T.StructField("money", T.DoubleType()),
    T.StructField("coffee_name", T.StringType()),
    T.StructField("Time_of_Day", T.StringType()),
    T.StructField("Weekday", T.StringType()),
    T.StructField("Month_name", T.StringType()),
    T.StructField("Weekdaysort", T.LongType()),
    T.StructField("Monthsort", T.LongType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Time", T.StringType()),
])

# Cell texts that a CSV reader with pandas' defaults takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

_FLOATS = (T.FloatType, T.DoubleType)


def q(name: str) -> str:
    """Back-quoted column name, safe for dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def normalize_missing(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL on every floating column.

    Spark ranks NaN above all numbers and lets it through sums and filters, so
    it must be gone before any statistic is taken.  Without floating columns
    the input plan is returned as it is.
    """
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATS)}
    if not floats:
        return df
    return df.select(*[
        F.nanvl(F.col(q(c)), F.lit(None).cast(column_type(df, c))).alias(c) if c in floats else F.col(q(c))
        for c in df.columns
    ])


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")


def require_list(value, what: str) -> list:
    """A bare string where a list is meant would be walked letter by letter."""
    if isinstance(value, str) or not isinstance(value, (list, tuple)):
        raise ValueError(f"{what} must be a list")
    return list(value)
