"""The full detection chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.forest import isolation_forest
from ..operators.ordered import temporal_anomaly
from ..operators.outliers import pattern_anomaly, statistical_outliers


@dataclass(frozen=True)
class DetectionPlan:
    """Columns and settings of the chain; a detector without its columns is left out."""

    outlier_columns: tuple[str, ...] = ("money", "hour_of_day")
    outlier_method: str = "iqr"
    outlier_threshold: float | None = None
    forest_columns: tuple[str, ...] = ("money", "hour_of_day", "Weekdaysort", "Monthsort")
    contamination: float = 0.1
    trees: int = 100
    date_column: str = "Date"
    value_column: str = "money"
    window: int = 7
    group_columns: tuple[str, ...] = ("coffee_name",)
    id_columns: tuple[str, ...] = ()


def detect_anomalies(df: DataFrame, plan: DetectionPlan = DetectionPlan()) -> DataFrame:
    """Statistical, isolation-forest, temporal and pattern flags, in that order.

    Without ``id_columns`` all columns together identify a row, which holds for
    de-duplicated sales.
    """
    ids = list(plan.id_columns) or sorted(df.columns, key=lambda c: c != "Time")  # time of day breaks date ties first
    flagged = statistical_outliers(df, list(plan.outlier_columns), plan.outlier_method, plan.outlier_threshold)
    if plan.forest_columns:
        flagged = isolation_forest(
            flagged, list(plan.forest_columns), ids,
            trees=plan.trees, contamination=plan.contamination)
    if plan.date_column in df.columns and plan.value_column in df.columns:
        flagged = temporal_anomaly(
            flagged, plan.date_column, plan.value_column, [c for c in ids if c != plan.date_column], plan.window,
            sort=False)
    if plan.group_columns and all(c in df.columns for c in plan.group_columns):
        flagged = pattern_anomaly(flagged, list(plan.group_columns), plan.value_column)
    return flagged
