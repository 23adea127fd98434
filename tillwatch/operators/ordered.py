"""Operators over the row order of the whole table.

Windows run per block of consecutive rows (``blocks``): the rows are shuffled once, each
block with the rows before it that its first frames reach into.  What must be carried
further, the nearest known point on either side, is found in narrow passes and travels as
literals, one for each block and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..functions.flags import beyond
from ..schema import column_type, is_numeric, q, require_columns, require_list
from .blocks import BLOCK, HALO, KEY, Blocks, sort_columns

LONG = 32  # frames of more rows are put together from running sums instead of being read row by row


def sort_by_date(df: DataFrame, date_column: str, ties: list[str]) -> DataFrame:
    return df.orderBy(*sort_columns([date_column, *require_list(ties, "ties")]))


def row_index(df: DataFrame, order_by: list[str], output: str = "row_index", blocks: int | None = None) -> DataFrame:
    """Global 0-based position of each row, without a single-task window."""
    cut = Blocks(df, order_by, blocks)
    within = F.row_number().over(Window.partitionBy(BLOCK).orderBy(*cut.order.sort))
    return cut.dealt(halo=False).withColumn(output, cut.start_of() + within - 1).drop(BLOCK, HALO)


def _with_frames(
    df: DataFrame, value_column: str, window: int, order_by: list[str], blocks: int | None, added: dict
) -> DataFrame:
    """Evaluate frame expressions over the trailing ``window`` rows of the whole table."""
    cut = Blocks(df, order_by, blocks, halo=window - 1)
    rows = cut.dealt()
    value = F.col(q(value_column)).cast("double")
    stats = ["__n", "__avg", "__std", "__min", "__max"]
    framed = (_read_frames if window <= LONG else _put_together)(rows, value, window, cut.order.sort)
    complete = F.col("__n") == F.lit(window)
    return (
        framed.filter(~F.col(HALO))
        .withColumns({name: make(complete) for name, make in added.items()})
        .drop(BLOCK, HALO, *stats)
    )


def _read_frames(rows: DataFrame, value: Column, window: int, order: list[Column]) -> DataFrame:
    frame = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(1 - window, 0)
    return rows.withColumns({
        "__n": F.count(value).over(frame), "__avg": F.avg(value).over(frame),
        "__std": F.stddev_samp(value).over(frame),
        "__min": F.min(value).over(frame), "__max": F.max(value).over(frame),
    })


def _put_together(rows: DataFrame, value: Column, window: int, order: list[Column]) -> DataFrame:
    """Frames of any length at the cost of a few running aggregates.

    A block is cut into stretches of ``window`` rows.  A frame is the end of one stretch
    and the beginning of the next: both are running aggregates, one in each direction, and
    their counts, means and squared deviations are merged.  Nothing is subtracted, so far
    values leave no trace in later frames, and a constant frame has exactly its value as
    mean and 0 as deviation.
    """
    place, stretch = F.col("__place"), F.col("__stretch")
    numbered = rows.withColumn("__place", F.row_number().over(Window.partitionBy(BLOCK).orderBy(*order)) - 1)
    numbered = numbered.withColumn("__stretch", F.floor(place / window))

    def running(side: str, by: Column) -> dict[str, Column]:
        frame = Window.partitionBy(BLOCK, "__stretch").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        return {f"__{side}": F.struct(
            F.count(value).over(frame).alias("n"), F.avg(value).over(frame).alias("avg"),
            (F.var_pop(value).over(frame) * F.count(value).over(frame)).alias("dev"),
            F.min(value).over(frame).alias("low"), F.max(value).over(frame).alias("high"))}

    both = numbered.withColumns(running("ends", place.desc())).withColumns(running("begins", place.asc()))
    before = F.lag("__ends", window - 1).over(Window.partitionBy(BLOCK).orderBy(stretch, place))
    both = both.withColumn("__before", F.when(place % window != window - 1, before))
    n, m = F.col("__begins.n"), F.coalesce(F.col("__before.n"), F.lit(0))
    low, high = F.least("__before.low", "__begins.low"), F.greatest("__before.high", "__begins.high")
    apart = F.coalesce(F.col("__before.avg") - F.col("__begins.avg"), F.lit(0.0))
    mean = F.coalesce(F.col("__begins.avg"), F.col("__before.avg")) + F.when((n > 0) & (m > 0), apart * m / (n + m)).otherwise(0.0)
    squares = (F.coalesce(F.col("__begins.dev"), F.lit(0.0)) + F.coalesce(F.col("__before.dev"), F.lit(0.0))
               + F.when((n > 0) & (m > 0), apart * apart * n * m / (n + m)).otherwise(0.0))
    flat = low == high
    return both.withColumns({
        "__n": n + m, "__avg": F.when(flat, low).otherwise(mean),
        "__std": F.when(n + m > 1, F.when(flat, 0.0).otherwise(F.sqrt(squares / (n + m - 1)))),
        "__min": low, "__max": high,
    }).drop("__place", "__stretch", "__ends", "__begins", "__before")


def _mean(complete: Column) -> Column:
    return F.when(complete, F.col("__avg"))


def _std(complete: Column) -> Column:
    return F.when(complete, F.col("__std"))


def rolling_mean(df, value_column, window, order_by, output="rolling_mean", blocks=None) -> DataFrame:
    """Mean of the last ``window`` rows, null unless all of them hold a value."""
    _check_window(df, value_column, window)
    return _with_frames(df, value_column, window, order_by, blocks, {output: _mean})


def rolling_std(df, value_column, window, order_by, output="rolling_std", blocks=None) -> DataFrame:
    """Sample standard deviation under the same rule."""
    _check_window(df, value_column, window)
    return _with_frames(df, value_column, window, order_by, blocks, {output: _std})


def temporal_anomaly(
    df: DataFrame,
    date_column: str,
    value_column: str,
    ties: list[str],
    window: int = 7,
    blocks: int | None = None,
    factor: float = 2.0,
    sort: bool = True,
) -> DataFrame:
    """Flag values more than two rolling deviations from the rolling mean; rows by date unless ``sort`` is off.

    A constant frame is never flagged (its rounded mean may differ from the
    value).  As a value is part of its own frame it can lie at most
    ``(n-1)/sqrt(n)`` deviations away, so frames of five rows or fewer never flag.
    """
    _check_window(df, value_column, window)
    value = F.col(q(value_column)).cast("double")

    def flag(complete: Column) -> Column:
        varied = F.col("__min") < F.col("__max")
        return F.coalesce(complete & varied & beyond(value, F.col("__avg"), F.col("__std"), factor), F.lit(False))

    order_by = [date_column, *require_list(ties, "ties")]
    flagged = _with_frames(df, value_column, window, order_by, blocks, {
        "rolling_mean": _mean, "rolling_std": _std, "temporal_anomaly": flag})
    return flagged.orderBy(*sort_columns(order_by)) if sort else flagged


def _check_window(df: DataFrame, value_column: str, window: int) -> None:
    require_columns(df, [value_column])
    if window < 1:
        raise ValueError("window must be at least 1")


def interpolate(
    df: DataFrame, columns: list[str] | None = None, order_by: list[str] | None = None, blocks: int | None = None
) -> DataFrame:
    """Linear fill by row position of numeric and date/time columns.

    Leading gaps stay, trailing gaps repeat the last value.  Columns without a gap are
    left alone; integer columns with gaps become double; dates keep their type, so a
    midpoint is cut to its day.  Known values never change.
    """
    sort_columns(order_by)
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    able = [c for c in df.columns
            if is_numeric(column_type(df, c)) or isinstance(column_type(df, c), temporal)]
    chosen = [c for c in (columns if columns is not None else able) if c in able and c not in order_by]
    if columns is not None:
        require_columns(df, columns)
    if not chosen:
        if columns is None and not able:
            raise ValueError("no numeric or date column to interpolate")
        return df
    gaps = df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"g{n}") for n, c in enumerate(chosen)]).first()
    chosen = [c for n, c in enumerate(chosen) if gaps[f"g{n}"]]
    if not chosen:
        return df

    cut = Blocks(df, order_by, blocks)
    before, after = _carried(cut, df, chosen)
    rows = cut.dealt(halo=False)
    within = F.row_number().over(Window.partitionBy(BLOCK).orderBy(*cut.order.sort))
    rows = rows.withColumn("__idx", cut.start_of() + within - 1)
    forward = Window.partitionBy(BLOCK).orderBy("__idx").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(BLOCK).orderBy(F.col("__idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    near = {}
    for n, c in enumerate(chosen):
        known = F.when(F.col(q(c)).isNotNull(), F.struct(F.col("__idx").alias("i"), _position(df, c).alias("v")))
        near[f"__p{n}"] = F.coalesce(F.last(known, ignorenulls=True).over(forward), before[n])
        near[f"__n{n}"] = F.coalesce(F.last(known, ignorenulls=True).over(backward), after[n])
    rows = rows.withColumns(near)
    filled = {c: F.coalesce(F.col(q(c)), _restore(df, c, _between(F.col(f"__p{n}"), F.col(f"__n{n}"))))
              for n, c in enumerate(chosen)}
    return rows.withColumns(filled).select(*[q(c) for c in df.columns])


def _carried(cut: Blocks, df: DataFrame, chosen: list[str]) -> tuple[list[Column], list[Column]]:
    """For every column the nearest known point before a row's block and after it, as literals.

    Two narrow passes with one row a block: the first and last known keys of a block, then
    how many of its rows come before them.
    """
    width = range(len(chosen))
    keyed = cut.keyed(df.select(*df.columns)).select(BLOCK, KEY, *[_position(df, c).alias(f"v{n}") for n, c in enumerate(chosen)])
    known = [F.when(F.col(f"v{n}").isNotNull(), F.struct(F.col(KEY).alias("k"), F.col(f"v{n}").alias("v"))) for n in width]
    ends = {r[BLOCK]: r for r in keyed.groupBy(BLOCK).agg(
        *[F.min(known[n]).alias(f"first{n}") for n in width], *[F.max(known[n]).alias(f"last{n}") for n in width]).collect()}

    def border(name: str) -> Column:
        # a block without a known point has null, which no row compares with
        keys = [cut.order.written(ends[b.number][name]["k"]) if b.number in ends and ends[b.number][name] else "NULL" for b in cut.found]
        return F.element_at(F.expr(f"array({', '.join(keys)})"), F.col(BLOCK) + 1)

    known_somewhere = {f"{side}{n}" for n in width for side in ("first", "last")
                       if any(r[f"{side}{n}"] for r in ends.values())}
    counts = {r[BLOCK]: r for r in keyed.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(KEY) < border(name)).alias(name) for name in sorted(known_somewhere)]).collect()}
    before, after = [], []
    for n in width:
        for name, walk, out in ((f"last{n}", cut.found, before), (f"first{n}", list(reversed(cut.found)), after)):
            nearest, carried = "NULL", {}
            for block in walk:
                carried[block.number] = nearest
                point = ends[block.number][name] if block.number in ends else None
                if point:
                    place = block.start + counts[block.number][name]
                    nearest = f"struct(CAST({place} AS BIGINT) AS i, CAST('{point['v']!r}' AS DOUBLE) AS v)"
            listed = ", ".join(carried[b.number] for b in cut.found)
            table = F.expr(f"array({listed})").cast("array<struct<i:bigint,v:double>>")
            out.append(F.element_at(table, F.col(BLOCK) + 1))
    return before, after


def _between(before: Column, after: Column) -> Column:
    i0, v0 = before.getField("i"), before.getField("v")
    i1, v1 = after.getField("i"), after.getField("v")
    part = F.try_divide((F.col("__idx") - i0).cast("double"), (i1 - i0).cast("double"))
    return (F.when(before.isNull(), F.lit(None).cast("double"))
            .when(after.isNull() | (i0 == i1), v0)
            .otherwise(v0 + (v1 - v0) * part))


def _position(df: DataFrame, column: str) -> Column:
    """The column on a numeric axis (days, microseconds, or itself)."""
    dtype = column_type(df, column)
    col = F.col(q(column))
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def _restore(df: DataFrame, column: str, value: Column) -> Column:
    dtype = column_type(df, column)
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.floor(value).cast("int"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.floor(value).cast("long")).cast(dtype)
    return value
