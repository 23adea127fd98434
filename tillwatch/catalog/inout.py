"""Sources, sinks and retention."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..operators.clean import drop_duplicates
from ..operators.outliers import statistical_outliers
from ..operators.reporting import anomaly_report
from ..operators.tables import profile
from ..plans.report import SHEET_MONTHLY, SHEET_SOURCE, SHEET_SUMMARY, SHEET_TOP, report_tables
from ..schema import SALES_SCHEMA
from ..session import scratch_path
from ..sources.csv import bad_dates, read_csv, read_sales
from ..sources import sample
from ..sources.sample import sales_of_index, seasonal_of_index
from ..sources.sinks import (
    drop_expired, read_anomaly_reports, write_anomaly_report, write_csv, write_parquet)
from ..sources.tables import read_parquet
from ..streaming.daily import read_daily, run_incremental
from ..streaming.rebuild import read_rebuilt, run_rebuilding
from ..sources.views import sales_view
from . import COPIES, GAPPY, LINES, SALES, copies, gappy, lines, query, rounded, sales

CANONICAL = [f.name for f in SALES_SCHEMA.fields]
_CANONICAL_SQL = ", ".join(f'"{c}"' if c[0].isupper() else c for c in CANONICAL)


@query("read_csv", f"WITH {GAPPY} SELECT id, hour_of_day, money, coffee_name FROM g")
def q_read_csv(spark, folder):
    path = scratch_path(spark, "csv")
    write_csv(gappy(spark, folder).select("id", "hour_of_day", "money", "coffee_name"), path, nullValue="N/A")
    return read_csv(spark, path)


@query("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_round_trip(spark, folder):
    """Whole texts with quotes, line breaks and blanks at their ends, written and read again."""
    path = scratch_path(spark, "texts-csv")
    table = read_parquet(spark, f"{folder}/documents.parquet")
    write_csv(table.select("doc_id", "text", "lang", "source", "n_chars"), path)
    return read_csv(spark, path, schema=T.StructType.fromDDL(
        "doc_id long, text string, lang string, source string, n_chars long"), keep_default_na=False)


@query("read_sales", f"WITH {GAPPY} SELECT {_CANONICAL_SQL} FROM g")
def q_read_sales(spark, folder):
    path = scratch_path(spark, "sales-csv")
    write_csv(gappy(spark, folder).select(*CANONICAL), path, nullValue="NaN")
    return read_sales(spark, path)


@query("read_sales_bad_dates", "SELECT count(*) AS bad_dates FROM events WHERE event_type = 'error'")
def q_bad_dates(spark, folder):
    path = scratch_path(spark, "dated-csv")
    text = F.when(F.col("coffee_name") == "error", "someday").otherwise(F.col("Date").cast("string"))
    write_csv(sales(spark, folder).select("id", text.alias("Date")), path)
    return bad_dates(spark, path)


@query("read_parquet", "SELECT * FROM orders")
def q_read_parquet(spark, folder):
    return read_parquet(spark, f"{folder}/orders.parquet")


_PROFILE_COLUMNS = {
    "id": "bigint", "ts": "timestamp_ntz", "hour_of_day": "bigint", "cash_type": "string", "money": "double", "coffee_name": "string",
    "Time_of_Day": "string", "Weekday": "string", "Month_name": "string", "Weekdaysort": "bigint", "Monthsort": "bigint",
    "Date": "date", "Time": "string"}


@query("profile", f"WITH {GAPPY} " + " UNION ALL ".join(
    f"""SELECT {i} AS "position", '{c}' AS "column", '{t}' AS dtype,
        count(*) - count("{c}") AS null_count, count(*) AS row_count FROM g"""
    for i, (c, t) in enumerate(_PROFILE_COLUMNS.items())))
def q_profile(spark, folder):
    return profile(gappy(spark, folder))


@query("synth_sales", """
SELECT o_orderkey AS id,
       CAST(([10, 12, 13, 15, 16])[o_orderkey % 5 + 1] AS BIGINT) AS hour_of_day,
       (['card', 'cash'])[o_orderkey % 2 + 1] AS cash_type,
       CAST(([38.7, 28.9, 33.8, 25.5, 42.0])[o_orderkey % 5 + 1] AS DOUBLE) AS money,
       (['Latte', 'Americano', 'Hot Chocolate', 'Cappuccino', 'Espresso'])[o_orderkey % 5 + 1] AS coffee_name,
       (['Morning', 'Afternoon', 'Evening'])[o_orderkey % 3 + 1] AS "Time_of_Day",
       (['Mon', 'Tue', 'Wed', 'Thu', 'Fri'])[o_orderkey % 5 + 1] AS "Weekday",
       (['Jan', 'Feb', 'Mar', 'Apr', 'May'])[o_orderkey % 5 + 1] AS "Month_name",
       o_orderkey % 5 + 1 AS "Weekdaysort", o_orderkey % 5 + 1 AS "Monthsort",
       DATE '2024-01-01' + CAST(o_orderkey AS INTEGER) AS "Date",
       printf('%02d:00:00', CAST((o_orderkey + 8) % 24 AS INTEGER)) AS "Time"
FROM orders""")
def q_synth_sales(spark, folder):
    """A sample sale for every order, numbered by its key."""
    return sales_of_index(spark.read.parquet(f"{folder}/orders.parquet"), "o_orderkey")


def _drawn(name: str) -> str:
    return f"CAST('0x' || substr(md5('7:{name}:' || event_id), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


def _placed(name: str, shares: list[int]) -> str:
    upto = [sum(shares[:n + 1]) for n in range(len(shares) - 1)]
    return " + ".join(f"CAST(({_drawn(name)}) * {sum(shares)} >= {u} AS INTEGER)" for u in upto)


_SEASONAL = f"""q AS (
  SELECT event_id AS id, {_placed("month", sample.SEASON)} AS m, {_drawn("day")} AS d, {_placed("hour", sample.HOURS)} + {sample.FIRST_HOUR} AS h,
    CAST(floor(({_drawn("minute")}) * 60) AS INTEGER) AS minute, {_placed("product", sample.PRODUCTS)} AS p,
    CAST(floor(({_drawn("price")}) * {sample.SPREAD}) AS BIGINT) + 950 AS price,
    CAST(floor(({_drawn("factor")}) * {sample.FACTORS}) AS BIGINT) + 40 AS factor,
    ({_drawn("planted")}) * 1000 < {sample.PLANTED} AS planted, CASE WHEN ({_drawn("payment")}) * 10 < 7 THEN 'card' ELSE 'cash' END AS cash_type
  FROM events),
y AS (SELECT *, make_date({sample.YEAR}, m + 1, CAST(floor(d * {sample.DAYS}[m + 1]) AS INTEGER) + 1) AS "Date",
        {[round(p * 100) for p in sample.SAMPLE_PRICES]}[p + 1] * price * CASE WHEN planted THEN factor ELSE 10 END // 10000 AS cents FROM q)"""


@query("synth_seasonal", f"""WITH {_SEASONAL}
SELECT id, CAST(h AS BIGINT) AS hour_of_day, cash_type, CAST(cents AS DOUBLE) / 100 AS money, {sample.SAMPLE_PRODUCTS}[p + 1] AS coffee_name,
       CASE WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS "Time_of_Day",
       strftime("Date", '%a') AS "Weekday", strftime("Date", '%b') AS "Month_name", CAST(isodow("Date") AS BIGINT) AS "Weekdaysort",
       CAST(m + 1 AS BIGINT) AS "Monthsort", "Date", printf('%02d:%02d:00', h, minute) AS "Time", planted
FROM y""")
def q_synth_seasonal(spark, folder):
    """A drawn sale for every event: season, peak hours, prices that vary, planted anomalies."""
    return seasonal_of_index(spark.read.parquet(f"{folder}/events.parquet"), "event_id")


@query("synth_recall", f"""WITH {_SEASONAL},
b AS (SELECT quantile_cont(CAST(cents AS DOUBLE) / 100, 0.25) AS q1, quantile_cont(CAST(cents AS DOUBLE) / 100, 0.75) AS q3 FROM y),
f AS (SELECT planted, cents / 100.0 > q3 + 1.5 * (q3 - q1) OR cents / 100.0 < q1 - 1.5 * (q3 - q1) AS flagged FROM y, b)
SELECT planted, count(*) AS n, count(*) FILTER (flagged) AS flagged FROM f GROUP BY 1""")
def q_synth_recall(spark, folder):
    """What the quartile rule finds of the planted anomalies, and what else it flags."""
    made = seasonal_of_index(spark.read.parquet(f"{folder}/events.parquet"), "event_id")
    flagged = statistical_outliers(made.select("planted", "money"), ["money"])
    return flagged.groupBy("planted").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("flagged"))


@query("write_csv", f"WITH {LINES} SELECT l_orderkey, l_linenumber, money, quantity, coffee_name, \"Date\" FROM l")
def q_write_csv(spark, folder):
    path = scratch_path(spark, "lines-csv")
    table = lines(spark, folder).select("l_orderkey", "l_linenumber", "money", "quantity", "coffee_name", "Date")
    write_csv(table, path)
    return read_csv(spark, path, schema=T.StructType(table.schema.fields))


@query("write_anomaly_report", f"""WITH {SALES},
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM s),
f AS (SELECT money < q1 - 1.5 * (q3 - q1) OR money > q3 + 1.5 * (q3 - q1) AS o FROM s, b),
c AS (SELECT count(*) AS total, count(*) FILTER (o) AS n FROM f)
SELECT flag, n AS "count", round_even(n * 100.0 / total, 2) AS percentage, '2024-02-01T09-00-00' AS run_ts
FROM c, (VALUES ('money_outlier'), ('is_outlier'), ('combined_anomalies')) v(flag)""")
def q_write_anomaly_report(spark, folder):
    path = scratch_path(spark, "report-json")
    report = anomaly_report(statistical_outliers(sales(spark, folder), ["money"]))
    write_anomaly_report(report, path, "2024-02-01T09-00-00")
    return read_anomaly_reports(spark, path)


@query("report_tables_source", f"WITH {GAPPY} SELECT * FROM g")
def q_report_source(spark, folder):
    return report_tables(gappy(spark, folder))[SHEET_SOURCE]


@query("report_tables_summary", f"""WITH {GAPPY},
k AS (SELECT round(coalesce(sum(money), 0), 2) AS a, CAST(count(*) AS DOUBLE) AS b,
             round(avg(money), 6) AS c, CAST(count(DISTINCT coffee_name) AS DOUBLE) AS d FROM g)
SELECT 'Total de Vendas' AS "Métrica", a AS "Valor" FROM k UNION ALL
SELECT 'Total de Transações', b FROM k UNION ALL
SELECT 'Ticket Médio', c FROM k UNION ALL
SELECT 'Produtos Únicos', d FROM k""")
def q_report_summary(spark, folder):
    table = report_tables(gappy(spark, folder))[SHEET_SUMMARY]
    digits = F.when(F.col("Métrica") == "Ticket Médio", F.round("Valor", 6)).otherwise(F.round("Valor", 2))
    return table.withColumn("Valor", digits)


@query("report_tables_top", f"""WITH {GAPPY}
SELECT coffee_name AS "Produto", round(sum(money), 2) AS "Total_Vendas" FROM g
WHERE coffee_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q_report_top(spark, folder):
    return rounded(report_tables(gappy(spark, folder))[SHEET_TOP], 2, "Total_Vendas")


@query("report_tables_monthly", f"""WITH {LINES}
SELECT strftime("Date", '%Y-%m') AS "Mês", round(sum(money), 2) AS "Vendas" FROM l GROUP BY 1""")
def q_report_monthly(spark, folder):
    return rounded(report_tables(lines(spark, folder))[SHEET_MONTHLY], 2, "Vendas")


@query("retain", """SELECT CAST(ts AS DATE) AS run_date, count(*) AS n FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1""")
def q_retain(spark, folder):
    """Ten days kept as of 2024-01-30, the cutoff day among them."""
    path = scratch_path(spark, "runs")
    table = sales(spark, folder).select("id", "money", F.col("Date").alias("run_date"))
    write_parquet(table, path, ["run_date"])
    drop_expired(spark, path, "2024-01-30", 10)
    kept = spark.read.schema(table.schema).parquet(path)
    return kept.groupBy("run_date").agg(F.count(F.lit(1)).alias("n"))


@query("incremental_daily", """
SELECT CAST(ts AS DATE) AS day, event_type AS coffee_name, round(sum(value), 2) AS sales, count(*) AS transactions
FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY 1, 2""")
def q_incremental_daily(spark, folder):
    """Days whose end the one-day watermark has passed."""
    out, state = scratch_path(spark, "daily"), scratch_path(spark, "daily-state")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    run_incremental(spark, folder, schema, out, state, transform=sales_view, files="events.parquet")
    return rounded(read_daily(spark, out), 2, "sales")


@query("incremental_late", "SELECT count(*) AS \"rows\", 0 AS late FROM events")
def q_incremental_late(spark, folder):
    """What a run reports: rows read, and sums that came too late (none when all files come at once)."""
    out, state = scratch_path(spark, "daily"), scratch_path(spark, "daily-state")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    seen = run_incremental(spark, folder, schema, out, state, transform=sales_view, files="events.parquet")
    return spark.createDataFrame([(seen["rows"], seen["late"])], "rows long, late long")


_LAST = "(SELECT max(CAST(ts AS DATE)) FROM events)"
_TOTALS = """SELECT CAST(ts AS DATE) AS day, event_type AS coffee_name, round(sum(value), 2) AS sales, count(value) AS transactions
FROM events GROUP BY 1, 2"""


def _deliver(spark, folder, again: int):
    """The events in three drops of ten days, a run after each; every 97th row comes with the last drop,
    ten days late or more, and ``again`` earlier drops are delivered once more with it."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    third = F.when(F.datediff(F.lit(last), F.to_date("ts")) >= 20, 0).when(F.datediff(F.lit(last), F.to_date("ts")) >= 10, 1).otherwise(2)
    drop = F.when(F.pmod("event_id", F.lit(97)) == 0, 2).otherwise(third)
    source, store, seen = scratch_path(spark, "drops"), scratch_path(spark, "rebuilt"), []
    for number in range(3):
        brought = events.filter(drop == number)
        brought.write.mode("append").parquet(source)
        if number == 2:
            for early in range(again):
                events.filter(drop == early).write.mode("append").parquet(source)
        seen.append(run_rebuilding(spark, source, events.schema, store, ["id"], transform=sales_view))
    return store, seen


@query("incremental_rebuilt", _TOTALS)
def q_incremental_rebuilt(spark, folder):
    """Totals of all days, although some of their rows come ten days late or more."""
    store, _ = _deliver(spark, folder, 0)
    return rounded(read_rebuilt(spark, store), 2, "sales")


@query("incremental_repeated", _TOTALS)
def q_incremental_repeated(spark, folder):
    """The same totals although the first two drops are delivered twice."""
    store, _ = _deliver(spark, folder, 2)
    return rounded(read_rebuilt(spark, store), 2, "sales")


@query("incremental_runs", f"""WITH d AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 2 WHEN {_LAST} - CAST(ts AS DATE) >= 20 THEN 0
                        WHEN {_LAST} - CAST(ts AS DATE) >= 10 THEN 1 ELSE 2 END AS run, CAST(ts AS DATE) AS day FROM events)
SELECT CAST(run AS BIGINT) AS run, count(*) + CASE WHEN run = 2 THEN (SELECT count(*) FROM d WHERE run < 1) ELSE 0 END AS "rows",
       count(*) AS stored, count(DISTINCT day) AS days FROM d GROUP BY run""")
def q_incremental_runs(spark, folder):
    """What each run read, stored and rebuilt when the first drop is delivered again with the last."""
    _, seen = _deliver(spark, folder, 1)
    return spark.createDataFrame([(n, s["rows"], s["stored"], s["days"]) for n, s in enumerate(seen)], "run long, rows long, stored long, days long")


@query("drop_duplicates", f"WITH {COPIES} SELECT DISTINCT * FROM d")
def q_drop_duplicates(spark, folder):
    return drop_duplicates(copies(spark, folder))
