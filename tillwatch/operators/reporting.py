"""Counting and showing flagged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.flags import any_flag, flag_columns, share
from ..schema import q, require_columns, require_list
from .ordered import sort_columns


def anomaly_report(df: DataFrame) -> DataFrame:
    """Rows ``flag, count, percentage`` for every boolean flag column.

    With more than one flag, ``combined_anomalies`` counts rows having any.  One
    pass; only counters are shuffled.
    """
    flags = flag_columns(df)
    if not flags:
        return df.sparkSession.createDataFrame([], "flag string, count long, percentage double")
    named = {f: F.col(q(f)) for f in flags}
    if len(flags) > 1:
        named["combined_anomalies"] = any_flag(flags)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(test).alias(f"n{i}") for i, test in enumerate(named.values())],
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f"n{i}").alias("count"),
                 share(F.col(f"n{i}"), F.col("total")).alias("percentage"))
        for i, f in enumerate(named)])))


def combined_anomalies(df: DataFrame) -> DataFrame:
    return anomaly_report(df).filter(F.col("flag") == "combined_anomalies")


def flagged_rows(df: DataFrame) -> DataFrame:
    return df.filter(any_flag(flag_columns(df)))


def split_flagged(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Normal and flagged rows; missing counts as normal."""
    require_columns(df, [flag])
    test = F.coalesce(F.col(q(flag)), F.lit(False))
    return df.filter(~test), df.filter(test)


def label_flagged(df: DataFrame, flag: str, x_column: str, y_column: str) -> DataFrame:
    """The two point series of an anomaly plot as one table with a label."""
    require_columns(df, [flag, x_column, y_column])
    label = F.when(F.coalesce(F.col(q(flag)), F.lit(False)), "anomaly").otherwise("normal")
    return df.select(F.col(q(x_column)), F.col(q(y_column)), label.alias("series"))


def select_examples(df: DataFrame, columns: list[str], order_by: list[str], n: int = 10) -> DataFrame:
    """First ``n`` flagged rows in ``order_by`` order, chosen columns plus all flags."""
    columns = require_list(columns, "columns")
    flags = flag_columns(df)
    shown = [c for c in columns if c not in flags] + flags
    return head_rows(flagged_rows(df), order_by, n).select(*[q(c) for c in shown])


def head_rows(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*sort_columns(order_by)).limit(n)
