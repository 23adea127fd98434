"""Exact quantiles without holding all distinct values in one buffer.

Spark's ``percentile`` keeps a map of every distinct value in a single
aggregation buffer, which a continuous column at scale does not fit.  Here the
bounded sketch of ``percentile_approx`` only brackets the wanted ranks, counting
shows exactly where the bracket lies, and the exact aggregate sees nothing but
the bracket.  Each pass is a map-side combined aggregate over one pruned column;
only scalars (global form) or small per-group tables (grouped form) travel.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..schema import column_type, q, require_columns, require_list
from ..session import materialize

SKETCH_ACCURACY = 10_000
DIRECT_ROWS = 100_000
MAX_ROUNDS = 20
GRID = 1_000


@dataclass
class _Rank:
    """An order statistic (0-based) known to lie in the closed interval [low, high]."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int
    value: float | None = None

    def settle(self) -> None:
        if self.value is None and self.low == self.high:
            self.value = self.low


def as_number(df: DataFrame, column: str) -> Column:
    """The column as double, with NaN taken as missing."""
    value = F.col(q(column)).cast("double")
    if isinstance(column_type(df, column), (T.FloatType, T.DoubleType)):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value


def _lerp(low: float, high: float, part: float) -> float:
    return low if low == high or part == 0 else low + (high - low) * part


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, exact at any size.

    All columns and all probabilities share each pass.  Runs two small jobs up
    to ``direct_rows`` non-missing values and three up to about
    ``direct_rows * accuracy / 4``; beyond that the bracket is narrowed again.
    """
    columns = require_list(columns, "columns")
    require_columns(df, columns)
    margin = 2.0 / accuracy
    grid = [min(1.0, max(0.0, p + side * margin)) for p in probs for side in (-1, 1)]
    names = {c: f"x{i}" for i, c in enumerate(columns)}
    data = df.select(*[as_number(df, c).alias(names[c]) for c in columns])

    first = data.agg(*[
        F.struct(
            F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
            F.percentile_approx(x, grid, accuracy).alias("sketch"),
        ).alias(x)
        for x in names.values()
    ]).first()

    targets: dict[tuple[str, int], _Rank] = {}
    proposals: dict[tuple[str, int], tuple[float, float]] = {}
    for c in columns:
        seen = first[names[c]]
        for i, p in enumerate(probs):
            for rank in _ranks(p, seen["n"]):
                key = (c, rank)
                targets[key] = _Rank(c, rank, seen["low"], seen["high"], 0, seen["n"])
                targets[key].settle()
                if seen["n"] > direct_rows:
                    proposals[key] = (seen["sketch"][2 * i], seen["sketch"][2 * i + 1])

    for turn in range(MAX_ROUNDS):
        _narrow(data, names, targets, proposals)
        open_ = {k: t for k, t in targets.items() if t.value is None}
        if not open_:
            break
        last = turn == MAX_ROUNDS - 1
        proposals = _select_or_sketch(
            data, names, open_, margin, accuracy, None if last else direct_rows)

    result: dict[str, list[float | None]] = {}
    for c in columns:
        n = first[names[c]]["n"]
        result[c] = []
        for p in probs:
            ranks = _ranks(p, n)
            values = [targets[(c, r)].value for r in ranks]
            part = p * (n - 1) - math.floor(p * (n - 1)) if n else 0.0
            result[c].append(_lerp(values[0], values[-1], part) if values else None)
    return result


def _ranks(p: float, n: int) -> list[int]:
    """The one or two ranks a linearly interpolated quantile lies between."""
    if n == 0:
        return []
    position = p * (n - 1)
    return sorted({math.floor(position), math.ceil(position)})


def _narrow(data, names, targets, proposals) -> None:
    """Adopt every proposed bracket that counting proves to hold its rank."""
    todo = {k: b for k, b in proposals.items() if targets[k].value is None}
    if not todo:
        return
    brackets = sorted({(names[c], lo, hi) for (c, _), (lo, hi) in todo.items()})
    counts = data.agg(*[
        F.struct(
            F.count_if(F.col(x) < lo).alias("below"),
            F.count_if(F.col(x) == lo).alias("at_low"),
            F.count_if((F.col(x) > lo) & (F.col(x) < hi)).alias("between"),
            F.count_if(F.col(x) == hi).alias("at_high"),
        ).alias(f"b{i}")
        for i, (x, lo, hi) in enumerate(brackets)
    ]).first()
    found = {b: counts[f"b{i}"] for i, b in enumerate(brackets)}
    for key, (lo, hi) in todo.items():
        # the ends are tested by themselves: a value that many rows share is never bracketed twice
        target, seen = targets[key], found[(names[key[0]], lo, hi)]
        place = target.rank - seen["below"]
        if place < 0:
            continue
        if place < seen["at_low"]:
            target.value = lo
        elif place < seen["at_low"] + seen["between"]:
            target.low, target.high = math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf)
            target.below, target.inside = seen["below"] + seen["at_low"], seen["between"]
            target.settle()
        elif lo < hi and place < seen["at_low"] + seen["between"] + seen["at_high"]:
            target.value = hi


def _select_or_sketch(data, names, open_, margin, accuracy, direct_rows):
    """One pass: read off ranks whose bracket is small, sketch inside the others."""
    keys = list(open_)
    tagged = data.select(*[
        F.when(F.col(names[c]).between(open_[(c, r)].low, open_[(c, r)].high), F.col(names[c])).alias(f"t{i}")
        for i, (c, r) in enumerate(keys)
    ])
    aggregates, direct = [], set()
    for i, key in enumerate(keys):
        t = open_[key]
        place = (t.rank - t.below + 0.5) / t.inside
        if direct_rows is None or t.inside <= direct_rows:
            direct.add(key)
            aggregates.append(F.expr(f"percentile_disc({place!r}D) WITHIN GROUP (ORDER BY t{i})").alias(f"t{i}"))
        else:
            sides = [min(1.0, max(0.0, place - margin)), min(1.0, place + margin)]
            aggregates.append(F.percentile_approx(f"t{i}", sides, accuracy).alias(f"t{i}"))
    row = tagged.agg(*aggregates).first()
    proposals = {}
    for i, key in enumerate(keys):
        if key in direct:
            open_[key].value = row[f"t{i}"]
        else:
            proposals[key] = tuple(row[f"t{i}"])
    return proposals


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float], method: str = "exact"):
    """``exact`` (bracketed), ``builtin`` (one-buffer percentile) or ``approx`` (sketch only)."""
    if method == "exact":
        return exact_quantiles(df, columns, probs)
    if method not in ("builtin", "approx"):
        raise ValueError(f"unknown quantile method {method!r}")
    make = (lambda x: F.percentile(x, probs)) if method == "builtin" else (
        lambda x: F.percentile_approx(x, probs, SKETCH_ACCURACY))
    row = df.agg(*[make(as_number(df, c)).alias(f"x{i}") for i, c in enumerate(columns)]).first()
    return {c: list(row[f"x{i}"] or [None] * len(probs)) for i, c in enumerate(columns)}


def iqr_bounds(df: DataFrame, columns: list[str], threshold: float = 1.5, method: str = "exact"):
    """Per column ``(q1, q3, iqr, lower, upper)``, or None for an all-missing column."""
    bounds = {}
    for c, (q1, q3) in column_quantiles(df, columns, [0.25, 0.75], method).items():
        if q1 is None:
            bounds[c] = None
            continue
        iqr = q3 - q1
        bounds[c] = (q1, q3, iqr, q1 - threshold * iqr, q3 + threshold * iqr)
    return bounds


def quantile_bounds(df: DataFrame, columns: list[str], threshold: float = 1.5, method: str = "exact") -> DataFrame:
    """The same as a table, one row per column."""
    found = iqr_bounds(df, require_list(columns, "columns"), threshold, method)
    rows = [(c, *(b if b else (None,) * 5)) for c, b in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, q3 double, iqr double, lower double, upper double")


def median_and_mad(df: DataFrame, columns: list[str], method: str = "exact"):
    """Per column ``(median, median absolute deviation)`` over non-missing values."""
    medians = {c: v[0] for c, v in column_quantiles(df, columns, [0.5], method).items()}
    spread = df.select(*[
        F.abs(as_number(df, c) - F.lit(medians[c])).alias(c) for c in columns if medians[c] is not None])
    mads = column_quantiles(spread, spread.columns, [0.5], method) if spread.columns else {}
    return {c: (medians[c], mads[c][0] if c in mads else None) for c in columns}


def median_abs_dev(df: DataFrame, columns: list[str], method: str = "exact") -> DataFrame:
    found = median_and_mad(df, require_list(columns, "columns"), method)
    return df.sparkSession.createDataFrame(
        [(c, m, d) for c, (m, d) in found.items()], "column string, median double, mad double")


def grouped_quantile(
    df: DataFrame,
    keys: list[str],
    column: str,
    prob: float,
    output: str,
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One exact quantile per group; groups of any size, rows with a missing key dropped.

    Every group is a bracket that holds its ranks, at first all its values, and is read off
    from (value, count) pairs summed map-side.  A bracket of more than ``direct_rows`` rows
    is narrowed by sketches first, so no group is ever gathered in one task.
    """
    keys = require_list(keys, "keys")
    present = as_number(df, column).isNotNull()
    for k in keys:
        present = present & F.col(q(k)).isNotNull()
    names = [q(k) for k in keys]
    data = df.filter(present).select(*names, as_number(df, column).alias("__x"))
    position = F.lit(float(prob)) * (F.col("__n") - 1)
    state = materialize(data.groupBy(*names).agg(F.count("__x").alias("__n")).select(
        *names,
        F.floor(position).alias("__r0"), F.ceil(position).alias("__r1"),
        (position - F.floor(position)).alias("__part"),
        F.lit(float("-inf")).alias("__lo"), F.lit(float("inf")).alias("__hi"),
        F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__inside"), F.lit(False).alias("__tied"),
    ), "group-brackets")
    for _ in range(MAX_ROUNDS):
        check = state.agg(
            F.max(F.when((F.col("__lo") < F.col("__hi")) & ~F.col("__tied"), F.col("__inside"))),
            F.count_if((F.col("__r0") < F.col("__below"))
                       | (F.col("__r1") >= F.col("__below") + F.col("__inside"))),
        ).first()
        if check[1]:
            raise RuntimeError("quantile bracket missed its rank")
        if check[0] is None or check[0] <= direct_rows:
            break
        state = materialize(_narrow_groups(data, state, keys, accuracy, direct_rows), "group-brackets")
    return _read_off_groups(data, state, keys, output)


def _narrow_groups(data, state, keys, accuracy, direct_rows):
    """Replace each large bracket by two neighbouring grid points of its sketch.

    A bracket that keeps more than half of its rows has values at its ends that
    many rows share, and few rows between; it is read off as it is.
    """
    names = [q(k) for k in keys]
    grid = [i / GRID for i in range(GRID + 1)]
    open_ = (F.col("__inside") > direct_rows) & (F.col("__lo") < F.col("__hi")) & ~F.col("__tied")
    wide, kept = state.filter(open_), state.filter(~open_)
    within = F.col("__x").between(F.col("__lo"), F.col("__hi"))
    sketch = (data.join(wide, keys).filter(within).groupBy(*names)
              .agg(F.percentile_approx("__x", grid, accuracy).alias("__s"), F.min("__x").alias("__mn"),
                   F.max("__x").alias("__mx")))
    step = lambda rank: (rank - F.col("__below")) * F.lit(GRID) / F.col("__inside")
    left = F.floor(step(F.col("__r0"))).cast("int") - 1
    right = F.ceil(step(F.col("__r1") + 1)).cast("int") + 1
    bracket = wide.join(sketch, keys).select(
        *names, "__r0", "__r1", "__part", F.col("__inside").alias("__before"),
        F.when(left < 0, F.col("__mn")).otherwise(F.try_element_at("__s", F.greatest(left, F.lit(0)) + 1)).alias("__lo"),
        F.when(right > GRID, F.col("__mx")).otherwise(F.try_element_at("__s", F.least(right, F.lit(GRID)) + 1)).alias("__hi"),
    )
    bracket = materialize(bracket, "group-sketch")
    counted = (data.join(bracket, keys).groupBy(*names)
               .agg(F.count_if(F.col("__x") < F.col("__lo")).alias("__below"),
                    F.count_if(within).alias("__inside")))
    narrowed = bracket.join(counted, keys).withColumn("__tied", F.col("__inside") * 2 > F.col("__before")).drop("__before")
    return kept.unionByName(narrowed)


def _read_off_groups(data, state, keys, output):
    """Cumulate (value, count) pairs inside the bracket and pick the two ranks."""
    names = [q(k) for k in keys]
    pairs = (data.join(state, keys).filter(F.col("__x").between(F.col("__lo"), F.col("__hi")))
             .groupBy(*names, "__x", "__r0", "__r1", "__part", "__below").agg(F.count("*").alias("__c")))
    upto = F.sum("__c").over(Window.partitionBy(*names).orderBy("__x")) + F.col("__below")
    pairs = pairs.withColumn("__upto", upto)
    holds = lambda r: (F.col(r) < F.col("__upto")) & (F.col(r) >= F.col("__upto") - F.col("__c"))
    ends = pairs.groupBy(*names).agg(
        F.max(F.when(holds("__r0"), F.col("__x"))).alias("__v0"),
        F.max(F.when(holds("__r1"), F.col("__x"))).alias("__v1"),
        F.first("__part").alias("__part"),
    )
    value = F.when(F.col("__v0") == F.col("__v1"), F.col("__v0")).otherwise(
        F.col("__v0") + (F.col("__v1") - F.col("__v0")) * F.col("__part"))
    return ends.select(*names, value.alias(output))
