"""From raw sales to the table every report and detector reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.clean import clean, remove_outliers_iqr
from ..operators.features import add_calculated_columns
from ..session import materialize


def transform_sales(
    df: DataFrame,
    trim: bool = True,
    threshold: float = 1.5,
    quantiles: str = "exact",
    watch: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Clean, derive, then cut price outliers.

    The category is set before the cut, and the quartiles are those of the
    cleaned rows.  The distinct rows are written once: the quantile passes and
    every use of the result read them, none repeats the de-duplication.
    """
    derived = add_calculated_columns(materialize(clean(df, watch=watch), "cleaned"))
    return remove_outliers_iqr(derived, "money", threshold, quantiles) if trim else derived
