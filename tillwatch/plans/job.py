"""The daily job: extract, transform, detect, report, retain."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.reporting import anomaly_report
from ..session import list_dirs, materialize, scratch_scope
from ..sources.csv import READ_OPTIONS, read_sales
from ..sources.sinks import drop_expired, write_anomaly_report, write_csv, write_parquet
from .detect import DetectionPlan, detect_anomalies
from .report import complete_report
from .transform import transform_sales


@dataclass(frozen=True)
class JobConfig:
    # Default settings of a run.
    data_path: str = "data/raw/"
    processed_path: str = "data/processed/"
    reports_path: str = "reports/"
    input_file: str = "Coffe_sales.csv"
    output_file: str = "Coffe_sales_with_anomalies.csv"
    anomaly_threshold: float = 0.1
    enable_anomaly_detection: bool = True
    enable_reporting: bool = True
    retention_days: int = 30
    trim: bool = True
    detection: DetectionPlan = field(default_factory=DetectionPlan)

    @classmethod
    def merged(cls, changes: dict) -> "JobConfig":
        """Defaults overlaid with ``changes``; unknown keys raise."""
        unknown = set(changes) - {f.name for f in dataclasses.fields(cls)}
        if unknown:
            raise ValueError(f"unknown configuration keys: {sorted(unknown)}")
        changes = dict(changes)
        if isinstance(changes.get("detection"), dict):
            values = {k: tuple(v) if isinstance(v, list) else v for k, v in changes["detection"].items()}
            changes["detection"] = DetectionPlan(**values)
        return cls(**changes)

    @classmethod
    def from_json(cls, path: str) -> "JobConfig":
        with open(path, encoding="utf-8") as handle:
            return cls.merged(json.load(handle))

    def detection_plan(self) -> DetectionPlan:
        return dataclasses.replace(self.detection, contamination=self.anomaly_threshold)


@dataclass
class Stage:
    name: str
    success: bool
    rows: int | None = None
    columns: int | None = None
    error: str | None = None


@dataclass
class JobResult:
    start_time: dt.datetime
    stages: list[Stage] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    success: bool = False
    error: str | None = None
    end_time: dt.datetime | None = None
    duration: dt.timedelta | None = None
    table: DataFrame | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """Rows removed by each cleaning step and rows flagged by each detector."""
        return spark.createDataFrame(list(self.counts.items()), "metric string, value long")

    def stage_metrics(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(s.name, s.success, s.rows, s.columns, s.error) for s in self.stages],
            "stage string, success boolean, rows long, columns int, error string")


def _at(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def run_job(
    spark: SparkSession,
    config: JobConfig = JobConfig(),
    run_ts: dt.datetime | None = None,
    source: DataFrame | None = None,
) -> JobResult:
    """One run over ``source`` (or the configured input file).

    The cleaned rows are written once and feed detection and reporting;
    intermediates are gone when the run ends, and the result reads the outputs.
    Row counts come from an observation on the first scan and from the written
    tables' footers.  A failing detection is recorded and the run goes on with
    the unflagged table; any other failure ends the run with ``success=False``.
    """
    result = JobResult(start_time=dt.datetime.now())
    stamp = run_ts or result.start_time
    try:
        with scratch_scope(spark):
            _run(spark, config, stamp, source, result)
        result.success = all(s.success for s in result.stages)
    except Exception as failure:
        result.error = str(failure)
    result.end_time = dt.datetime.now()
    result.duration = result.end_time - result.start_time
    return result


def _run(spark, config, stamp, source, result) -> None:
    raw = source if source is not None else read_sales(spark, config.input_file, config.data_path)
    seen: dict[str, Observation] = {}

    def watch(table: DataFrame, step: str) -> DataFrame:
        seen[step] = Observation(step)
        return table.observe(seen[step], F.count(F.lit(1)).alias("rows"))

    # Narrow columns and filters over a written table.
    table = transform_sales(watch(raw, "read"), trim=config.trim, watch=watch)
    read, distinct, complete = (seen[step].get["rows"] for step in ("read", "distinct", "complete"))
    kept = table.count()
    result.counts = {
        "rows_read": read, "duplicates_removed": read - distinct, "incomplete_removed": distinct - complete,
        "outliers_removed": complete - kept}
    result.stages.append(Stage("extraction", True, read, len(raw.columns)))
    result.stages.append(Stage("transformation", True, kept, len(table.columns)))

    if config.enable_anomaly_detection:
        table = _detect(spark, config, stamp, table, result)
    else:
        result.table = _save(spark, table, _at(config.processed_path, config.output_file))

    if config.enable_reporting:
        _report(spark, config, stamp, table, result)

    removed = 0
    for name in list_dirs(spark, config.reports_path):
        column = "run_ts" if name == "anomaly_report" else "run_date"
        removed += len(drop_expired(
            spark, _at(config.reports_path, name), stamp.date(), config.retention_days, column))
    result.stages.append(Stage("cleanup", True, removed))


def _save(spark, table, path) -> DataFrame:
    """Write by the path's ending and return the written table."""
    reader = spark.read.schema(table.schema)
    if path.endswith(".csv"):
        write_csv(table, path)
        return reader.options(**READ_OPTIONS, multiLine=True).csv(path)
    write_parquet(table, path)
    return reader.parquet(path)


def _detect(spark, config, stamp, table, result) -> DataFrame:
    """The flagged table, written once as the run's output; report and counts are read from it."""
    output = _at(config.processed_path, config.output_file)
    try:
        flagged = _save(spark, detect_anomalies(table, config.detection_plan()), output)
        run = stamp.strftime("%Y-%m-%dT%H-%M-%S")
        report = materialize(anomaly_report(flagged), "flags")
        write_anomaly_report(report, _at(config.reports_path, "anomaly_report"), run)
        kept = flagged.count()
        result.counts |= {r["flag"]: r["count"] for r in report.collect()}  # one row per flag
        result.counts["ungrouped_removed"] = table.count() - kept
        result.stages.append(Stage("anomaly_detection", True, kept, len(flagged.columns)))
        result.table = flagged
        return flagged
    except Exception as failure:
        result.stages.append(Stage("anomaly_detection", False, error=str(failure)))
        result.table = _save(spark, table, output)
        return table


def _report(spark, config, stamp, table, result) -> None:
    """Write the report tables side by side: each is a few small tasks over the cube."""
    tables = complete_report(table)
    day = F.lit(stamp.date())

    def write(name: str) -> DataFrame:
        path = _at(config.reports_path, name)
        dated = tables[name].withColumn("run_date", day)
        write_parquet(dated, path, ["run_date"], rebalance=False)  # one day, few rows
        return spark.read.schema(dated.schema).parquet(path).filter(F.col("run_date") == day).drop("run_date")

    with ThreadPoolExecutor(4) as pool:
        result.tables = dict(zip(tables, pool.map(write, tables)))
    result.stages.append(Stage("reporting", True, len(tables)))
