"""Summaries, the complete report and the daily job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.features import sales_category
from ..plans.job import JobConfig, run_job
from ..plans.report import (
    complete_report, daily_sales, date_range, monthly_sales, sales_by_category, sales_by_period, sales_summary,
    stats_by_product)
from ..schema import q
from ..session import scratch_path
from . import CATEGORY, COPIES, GAPPY, LINES, copies, gappy, lines, query, rounded, sales
from .model_sql import chain_sql

_KPI = """k AS (SELECT round(coalesce(sum(money), 0), 2) AS a, CAST(count(*) AS DOUBLE) AS b, round(avg(money), 6) AS c,
             CAST(count(DISTINCT coffee_name) AS DOUBLE) AS d FROM {t}),
kpi AS (SELECT 'total_sales' AS metric, a AS "value" FROM k UNION ALL SELECT 'total_transactions', b FROM k
        UNION ALL SELECT 'average_transaction', c FROM k UNION ALL SELECT 'unique_products', d FROM k)"""


def _kpi(table):
    value = F.when(F.col("metric") == "average_transaction", F.round("value", 6)).otherwise(F.round("value", 2))
    return table.withColumn("value", value)


@query("sales_summary", f"WITH {GAPPY}, {_KPI.format(t='g')} SELECT * FROM kpi")
def q_summary(spark, folder):
    return _kpi(sales_summary(gappy(spark, folder)))


@query("date_range", f"""WITH {LINES}
SELECT strftime(min("Date"), '%Y-%m-%d') AS "start", strftime(max("Date"), '%Y-%m-%d') AS "end" FROM l""")
def q_range(spark, folder):
    return date_range(lines(spark, folder))


@query("monthly_sales", f"""WITH {LINES}
SELECT CAST(date_trunc('month', "Date") AS DATE) AS "month", round(sum(money), 2) AS sales FROM l GROUP BY 1""")
def q_monthly(spark, folder):
    return rounded(monthly_sales(lines(spark, folder)), 2, "sales")


@query("daily_sales", f"""WITH {GAPPY}
SELECT "Date" AS "day", round(sum(money), 2) AS sales FROM g GROUP BY 1""")
def q_daily(spark, folder):
    return rounded(daily_sales(gappy(spark, folder)), 2, "sales")


@query("sales_by_period", f"""WITH {GAPPY}
SELECT "Time_of_Day", round(sum(money), 2) AS money_sum, count(money) AS money_count FROM g GROUP BY 1""")
def q_period(spark, folder):
    return rounded(sales_by_period(gappy(spark, folder)), 2, "money_sum")


@query("sales_by_category", f"""WITH {GAPPY}, c AS (SELECT {CATEGORY} AS sales_category, money FROM g)
SELECT sales_category, round(sum(money), 2) AS money_sum, count(money) AS money_count
FROM c WHERE sales_category IS NOT NULL GROUP BY 1""")
def q_category(spark, folder):
    return rounded(sales_by_category(sales_category(gappy(spark, folder))), 2, "money_sum")


@query("stats_by_product", f"""WITH {GAPPY}
SELECT coffee_name, round(sum(money), 2) AS money_sum, round(avg(money), 6) AS money_mean, count(money) AS money_count
FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_product(spark, folder):
    return rounded(rounded(stats_by_product(gappy(spark, folder)), 2, "money_sum"), 6, "money_mean")


@query("complete_report", f"""WITH {GAPPY}, {_KPI.format(t='g')},
e AS (SELECT min(money) AS mn, max(money) AS mx, (max(money) - min(money)) / 30 AS w FROM g),
h AS (SELECT i, mn + (i - 1) * w AS lo, CASE WHEN i = 30 THEN mx ELSE mn + i * w END AS hi FROM range(1, 31) r(i), e),
hc AS (SELECT i, lo, hi, count(money) AS n FROM h LEFT JOIN g ON money >= lo AND (money < hi OR i = 30 AND money = hi) GROUP BY ALL)
SELECT 'kpi' AS section, metric AS label, 'value' AS field, "value" FROM kpi UNION ALL
SELECT 'monthly', strftime("Date", '%Y-%m-01'), 'sales', round(sum(money), 2) FROM g GROUP BY 2 UNION ALL
SELECT 'daily', CAST("Date" AS VARCHAR), 'sales', round(sum(money), 2) FROM g GROUP BY 2 UNION ALL
SELECT 'top_products', coffee_name, 'sales', round(sum(money), 2) FROM g WHERE coffee_name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'by_product', coffee_name, 'money_sum', round(sum(money), 2) FROM g WHERE coffee_name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'by_product', coffee_name, 'money_mean', round(avg(money), 6) FROM g WHERE coffee_name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'by_product', coffee_name, 'money_count', CAST(count(money) AS DOUBLE) FROM g WHERE coffee_name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'by_period', "Time_of_Day", 'money_sum', round(sum(money), 2) FROM g GROUP BY 2 UNION ALL
SELECT 'by_period', "Time_of_Day", 'money_count', CAST(count(money) AS DOUBLE) FROM g GROUP BY 2 UNION ALL
SELECT 'by_category', {CATEGORY}, 'money_sum', round(sum(money), 2) FROM g WHERE money > 0 GROUP BY 2 UNION ALL
SELECT 'by_category', {CATEGORY}, 'money_count', CAST(count(money) AS DOUBLE) FROM g WHERE money > 0 GROUP BY 2 UNION ALL
SELECT 'heatmap', coffee_name, m, round(coalesce(sum(money) FILTER (strftime("Date", '%Y-%m') = m), 0), 2)
FROM g, (SELECT DISTINCT strftime("Date", '%Y-%m') AS m FROM g) WHERE coffee_name IS NOT NULL GROUP BY 2, 3 UNION ALL
SELECT 'histogram', CAST(i AS VARCHAR), 'bin_start', round(lo, 6) FROM hc UNION ALL
SELECT 'histogram', CAST(i AS VARCHAR), 'bin_end', round(hi, 6) FROM hc UNION ALL
SELECT 'histogram', CAST(i AS VARCHAR), 'count', CAST(n AS DOUBLE) FROM hc UNION ALL
SELECT 'date_range', strftime(min("Date"), '%Y-%m-%d') || ' ' || strftime(max("Date"), '%Y-%m-%d'), NULL, NULL FROM g""")
def q_complete(spark, folder):
    """All cells of all report tables in one long table."""
    tables = complete_report(sales_category(gappy(spark, folder)))
    digits = {"sales": 2, "money_sum": 2, "bin_start": 6, "bin_end": 6, "money_mean": 6}

    def part(name, label):
        cells = [c for c in tables[name].columns if c != label]
        long = tables[name].select(F.col(label).cast("string").alias("label"), *[
            F.round(F.col(q(c)).cast("double"), digits.get(c, 2 if name == "heatmap" else 9)).alias(c) for c in cells])
        return long.unpivot(["label"], [q(c) for c in cells], "field", "value").select(F.lit(name).alias("section"), "label", "field", "value")

    kpi = tables["kpi"].select(F.col("metric").cast("string"), F.col("value").cast("double"))
    kpi = _kpi(kpi).select(F.lit("kpi").alias("section"), F.col("metric").alias("label"), F.lit("value").alias("field"), "value")
    labels = {"monthly": "month", "daily": "day", "top_products": "coffee_name", "by_product": "coffee_name",
              "by_period": "Time_of_Day", "by_category": "sales_category", "heatmap": "coffee_name", "histogram": "bin"}
    whole = kpi.unionByName(tables["date_range"].select(
        F.lit("date_range").alias("section"), F.concat_ws(" ", "start", "end").alias("label"),
        F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("value")))
    for name, label in labels.items():
        whole = whole.unionByName(part(name, label))
    return whole


@query("stage_metrics", f"""WITH {COPIES},
u AS (SELECT DISTINCT * FROM d WHERE money IS NOT NULL AND coffee_name IS NOT NULL),
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM u),
n AS (SELECT count(*) AS kept FROM u, b WHERE money BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
SELECT 'extraction' AS stage, true AS success, (SELECT count(*) FROM d) AS "rows", 13 AS "columns", NULL::VARCHAR AS error UNION ALL
SELECT 'transformation', true, kept, 19, NULL FROM n UNION ALL
SELECT 'anomaly_detection', true, kept, 31, NULL FROM n UNION ALL
SELECT 'reporting', true, 10, NULL, NULL UNION ALL SELECT 'cleanup', true, 0, NULL, NULL""")
def q_job(spark, folder):
    """One run of the daily job, outputs in scratch; rows counted per stage."""
    return _run(spark, folder).stage_metrics(spark)


@query("job_metrics", f"""WITH {COPIES},
u AS (SELECT DISTINCT * FROM d), c AS (SELECT * FROM u WHERE money IS NOT NULL AND coffee_name IS NOT NULL),
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM c),
k AS MATERIALIZED (SELECT c.* FROM c, b WHERE money BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
{chain_sql("k")},
n AS (SELECT (SELECT count(*) FROM d) AS read, (SELECT count(*) FROM u) AS uniq, (SELECT count(*) FROM c) AS whole,
             (SELECT count(*) FROM k) AS kept)
SELECT 'rows_read' AS metric, read AS "value" FROM n UNION ALL SELECT 'duplicates_removed', read - uniq FROM n UNION ALL
SELECT 'incomplete_removed', uniq - whole FROM n UNION ALL SELECT 'outliers_removed', whole - kept FROM n UNION ALL
SELECT flag, "count" FROM tally UNION ALL SELECT 'ungrouped_removed', 0""")
def q_job_metrics(spark, folder):
    """Rows each cleaning step removed and each detector flagged."""
    return _run(spark, folder).metrics(spark)


_CLEAN = f"""WITH {COPIES},
u AS (SELECT DISTINCT * FROM d WHERE money IS NOT NULL AND coffee_name IS NOT NULL),
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM u),
n AS (SELECT count(*) AS kept FROM u, b WHERE money BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""


@query("stage_switches", _CLEAN + """
SELECT 'extraction' AS stage, true AS success, (SELECT count(*) FROM d) AS "rows", 13 AS "columns", NULL::VARCHAR AS error UNION ALL
SELECT 'transformation', true, kept, 19, NULL FROM n UNION ALL SELECT 'cleanup', true, 0, NULL, NULL""")
def q_switches(spark, folder):
    """Detection and reporting switched off: their stages are not there."""
    result = _run(spark, folder, enable_anomaly_detection=False, enable_reporting=False)
    return result.stage_metrics(spark)


@query("fail_soft", _CLEAN + """
SELECT 'extraction' AS stage, true AS success, (SELECT count(*) FROM d) AS "rows", 13 AS "columns", NULL::VARCHAR AS error UNION ALL
SELECT 'transformation', true, kept, 19, NULL FROM n UNION ALL
SELECT 'anomaly_detection', false, NULL, NULL, 'columns not in table: [''no_such_column'']' UNION ALL
SELECT 'reporting', true, 10, NULL, NULL UNION ALL SELECT 'cleanup', true, 0, NULL, NULL""")
def q_fail_soft(spark, folder):
    """A detector's column does not exist: its stage fails, the later ones run."""
    result = _run(spark, folder, detection={"forest_columns": ["no_such_column"]})
    return result.stage_metrics(spark)


@query("config_merge", """SELECT * FROM (VALUES
  ('anomaly_threshold', '0.2'), ('detection.trees', '30'), ('detection.window', '7'), ('enable_reporting', 'False'),
  ('output_file', 'Coffe_sales_with_anomalies.csv'), ('retention_days', '30'),
  ('rows', (SELECT CAST(count(*) AS VARCHAR) FROM events))) t(setting, "value")""")
def q_config(spark, folder):
    """Given settings replace defaults, the others stay; the row count is that of a run's input."""
    config = JobConfig.merged({"anomaly_threshold": 0.2, "enable_reporting": False, "detection": {"trees": 30}})
    rows = sales(spark, folder).agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("rows").alias("setting"), "value")
    shown = [("anomaly_threshold", config.anomaly_threshold), ("detection.trees", config.detection.trees),
             ("detection.window", config.detection.window), ("enable_reporting", config.enable_reporting),
             ("output_file", config.output_file), ("retention_days", config.retention_days)]
    return spark.createDataFrame([(k, str(v)) for k, v in shown], "setting string, value string").unionByName(rows)


def _run(spark, folder, **changes):
    root = scratch_path(spark, "job")
    config = JobConfig.merged({
        "processed_path": f"{root}/processed", "reports_path": f"{root}/reports", "output_file": "flagged.parquet",
        "detection": {"id_columns": ["id"]}, **changes})
    result = run_job(spark, config, dt.datetime(2024, 2, 1, 9), source=copies(spark, folder))
    if result.error:
        raise RuntimeError(result.error)
    return result
