"""Named aggregate functions with the null rules of the sales reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ..schema import q


def _sem(x: Column) -> Column:
    return F.stddev_samp(x) / F.sqrt(F.count(x).cast("double"))


def _skew(x: Column) -> Column:
    """Sample skewness; null below three values, zero for a constant group."""
    n = F.count(x).cast("double")
    adjusted = F.skewness(x) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, F.lit(None)).when(F.min(x) == F.max(x), 0.0).otherwise(adjusted)


def _total(x: Column) -> Column:
    total = F.sum(x)
    return F.coalesce(total, F.lit(0))


# Functions of one column.  All keep bounded state and combine map-side;
# count-distinct is spread by value first, so a hot group is not one task's work.
SIMPLE: dict[str, Callable[[Column], Column]] = {
    "sum": _total,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "size": lambda x: F.count(F.lit(1)),
    "std": F.stddev_samp,
    "var": F.var_samp,
    "sem": _sem,
    "nunique": F.count_distinct,
    "prod": lambda x: F.coalesce(F.product(x), F.lit(1.0)),
    "skew": _skew,
}
QUANTILES = {"median": 0.5, "quantile": 0.5}
ORDERED = ("first", "last")


def ordered_end(name: str, column: str, order_by: list[str]) -> Column:
    """First or last non-missing value in ``order_by`` order."""
    x = F.col(q(column))
    key = F.struct(*[F.struct(F.col(q(o)).isNull().alias("late"), F.col(q(o)).alias("key")) for o in order_by])
    pick = F.min_by if name == "first" else F.max_by
    return pick(x, F.when(x.isNotNull(), key))
