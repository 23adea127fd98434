"""Group-by, category completeness, group statistics and callables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.aggregates import ORDERED, QUANTILES, SIMPLE, ordered_end
from ..functions.bins import SALES_LABELS
from ..schema import column_type, q, require_columns, require_list
from ..session import materialize
from .quantiles import grouped_quantile


HELD = 10_000  # groups whose states a task holds before it passes them on
FAN_IN = 64    # states of one group that are folded together


@dataclass(frozen=True)
class Mergeable:
    """A caller's own aggregate in three pandas steps, safe for groups of any size.

    ``partial`` reduces a batch of values to one state, ``merge`` folds a list of
    states into one, ``finish`` turns the last into the result.  The state is any
    picklable value.  Each task merges its own batches, then states are folded
    ``FAN_IN`` at a time in as many levels as the number of tasks needs, so no task
    sees all rows or all states of a group.
    """

    name: str
    partial: Callable[[pd.Series], object]
    merge: Callable[[list], object]
    finish: Callable[[object], object]
    return_type: str = "double"


def aggregate(
    df: DataFrame,
    group_columns: list[str],
    agg_functions: dict[str, list],
    order_by: list[str] | None = None,
    sort: bool = True,
) -> DataFrame:
    """Group by columns, with ``{column}_{function}`` outputs, sorted by the keys.

    Rows with a missing key are dropped.  A function is a name, a callable from
    Column to aggregate Column, or ``Mergeable``.
    """
    keys = require_list(group_columns, "group_columns")
    if not keys:
        raise ValueError("group_columns must name at least one column")
    for column, functions in agg_functions.items():
        require_list(functions, f"functions of {column}")
    require_columns(df, [*keys, *agg_functions, *(order_by or [])])
    names = [q(k) for k in keys]
    rows = drop_null_keys(df, keys)

    simple: list[Column] = []
    outputs: list[str] = []
    joined: list[DataFrame] = []
    quantiles: dict[str, tuple[str, float]] = {}
    for column, functions in agg_functions.items():
        for function in functions:
            name = _function_name(function)
            output = f"{column}_{name}"
            outputs.append(output)
            if isinstance(function, Mergeable):
                joined.append(_merge_groups(rows, keys, column, function, output))
            elif callable(function):
                simple.append(function(F.col(q(column))).alias(output))
            elif name in SIMPLE:
                simple.append(SIMPLE[name](F.col(q(column))).alias(output))
            elif name in ORDERED:
                if not order_by:
                    raise ValueError(f"{name} needs order_by")
                simple.append(ordered_end(name, column, order_by).alias(output))
            elif name in QUANTILES:
                quantiles[output] = (column, QUANTILES[name])
            else:
                raise ValueError(f"unknown aggregate function {name!r}")

    twins: dict[tuple[str, float], list[str]] = {}
    for output, wanted in quantiles.items():
        twins.setdefault(wanted, []).append(output)
    for (column, prob), (first, *others) in twins.items():
        part = grouped_quantile(rows, keys, column, prob, first)
        joined.append(part.select("*", *[F.col(q(first)).alias(o) for o in others]))

    result = rows.groupBy(*names).agg(*(simple or [F.count(F.lit(1)).alias("__n")]))
    for part in joined:  # one row per group on both sides
        result = result.join(part, keys, "left")
    result = result.select(*names, *[q(o) for o in outputs])
    return result.orderBy(*names) if sort else result


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(q(k)).isNotNull()
    return df.filter(test)


def _function_name(function) -> str:
    if isinstance(function, str):
        return function
    return getattr(function, "name", None) or getattr(function, "__name__", "custom").strip("<>")


def _merge_groups(rows, keys, column, function: Mergeable, output) -> DataFrame:
    import pickle

    key_fields = [T.StructField(k, column_type(rows, k)) for k in keys]
    partial_schema = T.StructType([*key_fields, T.StructField("__state", T.BinaryType()),
                                   T.StructField("__lane", T.LongType())])
    partial, merge, finish = function.partial, function.merge, function.finish

    def batches(frames):
        held: dict = {}

        def flush():
            rows = [(*key, pickle.dumps(state), 0) for key, state in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=[*keys, "__state", "__lane"])

        for frame in frames:
            for key, values in frame.groupby(keys, sort=False)[column]:
                state = partial(values.dropna())
                held[key] = merge([held[key], state]) if key in held else state
            if len(held) > HELD:
                yield flush()
        yield flush()

    values = rows.select(*[q(k) for k in keys], q(column))
    tasks = max(1, values.rdd.getNumPartitions())
    states = values.mapInPandas(batches, partial_schema).withColumn("__lane", F.spark_partition_id().cast("long"))

    def fold(key, frame):
        merged = merge([pickle.loads(s) for s in frame["__state"]])
        return pd.DataFrame([(*key, pickle.dumps(merged))], columns=[*keys, "__lane", "__state"])

    folded, lanes = states, tasks
    lane_schema = T.StructType([*key_fields, T.StructField("__lane", T.LongType()), T.StructField("__state", T.BinaryType())])
    while lanes > FAN_IN:
        folded = folded.withColumn("__lane", F.floor(F.col("__lane") / FAN_IN)).groupBy(
            *[q(k) for k in keys], "__lane").applyInPandas(fold, lane_schema)
        lanes = -(-lanes // FAN_IN)
    final_schema = T.StructType([*key_fields, T.StructField(output, T._parse_datatype_string(function.return_type))])

    def close(key, frame):
        merged = merge([pickle.loads(s) for s in frame["__state"]])
        return pd.DataFrame([(*key, finish(merged))], columns=[*keys, output])

    return folded.groupBy(*[q(k) for k in keys]).applyInPandas(close, final_schema)


def aggregate_categories(
    df: DataFrame,
    group_columns: list[str],
    agg_functions: dict[str, list],
    category: str = "sales_category",
    levels: list[str] | None = None,
    observed: bool = False,
) -> DataFrame:
    """``aggregate`` where the category key also shows its empty levels, in level order.

    Empty levels give 0 for sums, counts and sizes, 1 for products, null otherwise.  With further keys
    every level appears for every observed combination of them.
    """
    levels = list(levels or SALES_LABELS)
    result = aggregate(df, group_columns, agg_functions, sort=False)
    others = [k for k in group_columns if k != category]
    ordinal = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(q(category)))
    if not observed:
        every = F.explode(F.array(*[F.lit(v) for v in levels])).alias(category)
        spark = df.sparkSession
        if others:
            frame = result.select(*[q(o) for o in others]).distinct().select(*[q(o) for o in others], every)
        else:
            frame = spark.range(1).select(every)
        result = frame.join(result, group_columns, "left")
        neutral = {"sum": 0, "count": 0, "size": 0, "nunique": 0, "prod": 1}
        fills = {f"{c}_{f}": neutral[f] for c, fs in agg_functions.items() for f in fs
                 if isinstance(f, str) and f in neutral}
        result = result.na.fill(fills) if fills else result
    return result.select(*[q(g) for g in group_columns], *[
        q(c) for c in result.columns if c not in group_columns
    ]).orderBy(*[ordinal if g == category else F.col(q(g)) for g in group_columns])


def group_stats(df: DataFrame, group_columns: list[str], value_column: str) -> DataFrame:
    """Mean, sample deviation, non-missing count, minimum and maximum per group."""
    keys = require_list(group_columns, "group_columns")
    require_columns(df, [*keys, value_column])
    value = F.col(q(value_column))
    return drop_null_keys(df, keys).groupBy(*[q(k) for k in keys]).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )


def join_group_stats(df: DataFrame, group_columns: list[str], value_column: str, extremes: bool = False) -> DataFrame:
    """Inner join of the rows to their group's mean, std and count.

    The statistics are aggregated map-side and written first.  Their true size
    then decides the join: under Spark's broadcast threshold they are broadcast
    and the rows are not shuffled; above it AQE's skew join splits hot keys.
    Colliding names get the ``_group`` suffix; rows with a missing key drop out.
    """
    keys = require_list(group_columns, "group_columns")
    stats = group_stats(df, keys, value_column)
    if not extremes:
        stats = stats.drop("min", "max")
    added = [c for c in stats.columns if c not in keys]
    stats = stats.select(*[q(k) for k in keys], *[
        F.col(q(c)).alias(f"{c}_group" if c in df.columns else c) for c in added])
    return df.join(materialize(stats, "group-stats"), keys, "inner").select(
        *[q(c) for c in df.columns], *[q(c) for c in stats.columns if c not in keys])


def count_distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of distinct non-missing values per column."""
    chosen = columns or df.columns
    return df.agg(*[F.count_distinct(q(c)).alias(c) for c in chosen])
