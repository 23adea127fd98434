"""Writers and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import q
from ..session import delete_path, list_dirs
from .csv import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, **options) -> None:
    """CSV folder of part files with a header line each; ``read_csv`` gives the same cells back."""
    df.write.mode("overwrite").options(**{**CSV_OPTIONS, **options}).csv(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, rebalance: bool = True
) -> None:
    """Parquet table; with partitions only those present in ``df`` are replaced.

    Rows are rebalanced by the partition columns first, so that not every task
    writes a file into every partition; AQE splits a partition holding much of
    the table over several tasks.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(q(c)) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_anomaly_report(report: DataFrame, path: str, run_ts: str) -> None:
    """JSON rows under ``run_ts=<stamp>``, next to the reports of other runs."""
    (report.withColumn("run_ts", F.lit(run_ts)).coalesce(1)  # one row per flag
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").json(path))


def read_anomaly_reports(spark: SparkSession, path: str) -> DataFrame:
    schema = "flag string, count long, percentage double, run_ts string"
    return spark.read.schema(schema).json(path)


def _cutoff(as_of: dt.date | str, days: int) -> dt.date:
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return day - dt.timedelta(days=days)


def retain(df: DataFrame, as_of: dt.date | str, days: int = 30, column: str = "run_date") -> DataFrame:
    """Rows of runs not older than ``days`` before ``as_of``; the cutoff day itself stays.

    On a table partitioned by the column this prunes whole folders.
    """
    return df.filter(F.col(q(column)) >= F.lit(_cutoff(as_of, days)))


def drop_expired(
    spark: SparkSession, path: str, as_of: dt.date | str, days: int = 30, column: str = "run_date"
) -> list[str]:
    """Remove the date partitions ``retain`` would filter out; returns their names.

    A metadata operation: no data file is read or rewritten.
    """
    limit = _cutoff(as_of, days)
    expired = []
    for name in list_dirs(spark, path):
        key, _, value = name.partition("=")
        if key != column:
            continue
        try:
            day = dt.date.fromisoformat(value[:10])
        except ValueError:
            continue  # null or foreign partition
        if day < limit:
            expired.append(name)
    for name in expired:
        delete_path(spark, f"{path.rstrip('/')}/{name}")
    return expired
