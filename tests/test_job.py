import datetime as dt
import json

import pytest

from helpers import local, plan
from tillwatch.operators.features import sales_category
from tillwatch.plans import job as job_module
from tillwatch.plans.detect import DetectionPlan
from tillwatch.plans.job import JobConfig, run_job
from tillwatch.plans.report import complete_report, report_cube, report_tables, sales_summary, top_products
from tillwatch.sources.sample import synth_sales
from tillwatch.sources.sinks import read_anomaly_reports, write_csv
from tillwatch.sources.views import sales_view
from tillwatch.streaming.daily import read_daily, run_incremental


def config(tmp_path, **changes) -> JobConfig:
    return JobConfig.merged({
        "data_path": str(tmp_path / "raw"), "processed_path": str(tmp_path / "processed"),
        "reports_path": str(tmp_path / "reports"), "input_file": "sales.csv",
        "detection": {"trees": 10}, **changes})


@pytest.fixture()
def sales_file(spark, tmp_path):
    write_csv(synth_sales(spark, 200).drop("id"), str(tmp_path / "raw" / "sales.csv"))
    return tmp_path


def test_full_run(spark, sales_file):
    cfg = config(sales_file)
    result = run_job(spark, cfg, dt.datetime(2024, 3, 1, 9))
    assert result.success and result.error is None and result.duration is not None
    rows = {s.name: s.rows for s in result.stages}
    assert rows == {"extraction": 200, "transformation": 200, "anomaly_detection": 200, "reporting": 10, "cleanup": 0}
    assert {k: result.counts[k] for k in ("rows_read", "duplicates_removed", "outliers_removed")} == {
        "rows_read": 200, "duplicates_removed": 0, "outliers_removed": 0}
    assert {r["metric"] for r in result.metrics(spark).collect()} >= {"temporal_anomaly", "combined_anomalies"}
    metrics = result.stage_metrics(spark)
    assert metrics.columns == ["stage", "success", "rows", "columns", "error"] and metrics.count() == 5
    flagged = spark.read.option("header", True).csv(f"{cfg.processed_path}/{cfg.output_file}")
    assert flagged.count() == 200 and "pattern_anomaly" in flagged.columns
    assert read_anomaly_reports(spark, f"{cfg.reports_path}/anomaly_report").count() == 7
    kpi = spark.read.parquet(f"{cfg.reports_path}/kpi").filter("run_date = '2024-03-01'")
    assert kpi.filter("metric = 'total_transactions'").first()["value"] == 200

    later = run_job(spark, cfg, dt.datetime(2024, 4, 15, 9))
    assert {s.name: s.rows for s in later.stages}["cleanup"] == 11  # ten tables and the flag report
    assert spark.read.parquet(f"{cfg.reports_path}/kpi").select("run_date").distinct().count() == 1


def test_switches_and_failures(spark, sales_file, monkeypatch):
    off = config(sales_file, enable_anomaly_detection=False, enable_reporting=False)
    result = run_job(spark, off, dt.datetime(2024, 3, 1))
    assert result.success and [s.name for s in result.stages] == ["extraction", "transformation", "cleanup"]
    assert "is_outlier" not in result.table.columns and result.tables == {}

    def broken(*_):
        raise RuntimeError("no detector")

    monkeypatch.setattr(job_module, "detect_anomalies", broken)
    soft = run_job(spark, config(sales_file, enable_reporting=False), dt.datetime(2024, 3, 1))
    stages = {s.name: s for s in soft.stages}
    assert not soft.success and soft.error is None
    assert stages["anomaly_detection"].error == "no detector" and stages["cleanup"].success

    gone = run_job(spark, config(sales_file, input_file="none.csv"), dt.datetime(2024, 3, 1))
    assert not gone.success and "none.csv" in gone.error and gone.stages == []


def test_config_is_merged(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"anomaly_threshold": 0.02, "retention_days": 7, "detection": {"window": 9}}))
    cfg = JobConfig.from_json(str(path))
    assert cfg.retention_days == 7 and cfg.input_file == "Coffe_sales.csv" and cfg.enable_reporting
    assert cfg.detection_plan().contamination == 0.02 and cfg.detection_plan().window == 9
    assert JobConfig().detection_plan() == DetectionPlan()
    with pytest.raises(ValueError):
        JobConfig.merged({"anomaly_treshold": 1})


def test_reports_from_the_cube_equal_the_direct_ones(spark, folder):
    from tillwatch.catalog import gappy
    from tillwatch.plans import report as r
    df = sales_category(gappy(spark, folder))
    tables = complete_report(df)
    direct = {
        "kpi": r.sales_summary(df), "monthly": r.monthly_sales(df), "daily": r.daily_sales(df),
        "top_products": r.top_products(df), "by_product": r.stats_by_product(df),
        "by_period": r.sales_by_period(df), "by_category": r.sales_by_category(df), "date_range": r.date_range(df)}
    for name, table in direct.items():
        ours, theirs = tables[name].collect(), table.collect()
        assert tables[name].columns == table.columns and len(ours) == len(theirs)
        for a, b in zip(ours, theirs):
            assert all(x == y or abs(x - y) < 1e-6 * max(1, abs(y)) for x, y in zip(a, b)), (name, a, b)
    assert report_cube(df).count() < df.count()


def test_reports_skip_absent_columns(spark):
    ids = spark.range(5)
    assert {r["metric"]: r["value"] for r in sales_summary(ids).collect()} == {
        "total_sales": 0, "total_transactions": 5, "average_transaction": 0, "unique_products": 0}
    assert set(report_tables(ids)) == {"Dados_Originais", "Resumo"}
    assert set(complete_report(ids)) == {"kpi"}
    approx = sales_summary(synth_sales(spark, 50), approximate=True)
    assert approx.filter("metric = 'unique_products'").first()["value"] == 5


def test_empty_sales(spark):
    empty = synth_sales(spark, 5).filter("id > 10")
    kpi = {r["metric"]: r["value"] for r in sales_summary(empty).collect()}
    assert kpi["total_sales"] == 0 and kpi["average_transaction"] is None
    assert [r for r in complete_report(empty)["date_range"].collect()] == [(None, None)]


def test_top_products_is_a_bounded_top_k(spark):
    out = top_products(synth_sales(spark, 100), 3)
    assert [r["coffee_name"] for r in out.collect()] == ["Espresso", "Latte", "Hot Chocolate"]
    assert "TakeOrderedAndProject" in plan(out)


def test_incremental_runs_take_only_new_files(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = dt.datetime(2024, 1, 1)

    def arrive(first_day, days, rows=20):
        data = [(i, start + dt.timedelta(days=first_day + d, minutes=i), i, "view", 1.0, "{}")
                for d in range(days) for i in range(rows)]
        df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        df.coalesce(1).write.mode("append").parquet(source)
        return df.schema

    schema = arrive(0, 3)
    run_incremental(spark, source, schema, out, state, transform=sales_view)
    done = local(read_daily(spark, out), "day")
    assert list(done["day"]) == [dt.date(2024, 1, 1)] and list(done["sales"]) == [20.0]
    run_incremental(spark, source, schema, out, state, transform=sales_view)
    assert read_daily(spark, out).count() == 1
    arrive(3, 3)
    arrive(0, 1)  # behind the watermark
    run_incremental(spark, source, schema, out, state, transform=sales_view)
    done = local(read_daily(spark, out), "day")
    assert list(done["day"]) == [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    assert set(done["sales"]) == {20.0} and set(done["transactions"]) == {20}


def test_incremental_days_are_local_days(spark, tmp_path, folder):
    """Same days whatever the session's time zone."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    before = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out, state = str(tmp_path / zone / "out"), str(tmp_path / zone / "state")
            run_incremental(spark, folder, schema, out, state, transform=sales_view, files="events.parquet")
            found.append(sorted((r["day"], r["coffee_name"], r["transactions"]) for r in read_daily(spark, out).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == 140


def test_late_rows_are_counted(spark, tmp_path):
    """A row two days behind the watermark of an earlier run is left out, and the run says so."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(n, *days):
        rows = [(n * 10 + i, dt.datetime(2024, 1, d, 12), 1, "view", 1.0, "") for i, d in enumerate(days)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        return run_incremental(spark, source, spark.createDataFrame([], schema).schema, out, state, transform=sales_view)

    assert arrive(1, 1, 2, 9) == {"rows": 3, "late": 0}
    arrive(2, 10)
    seen = arrive(3, 3, 11)
    assert seen["late"] == 1
