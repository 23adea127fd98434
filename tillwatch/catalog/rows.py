"""Derived columns, filters, cleaning and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import format_date, parse_date, to_day, to_month
from ..operators.clean import clean, drop_missing, fill_median, fill_mode, remove_outliers_iqr
from ..operators.features import bin_column, calendar_columns, sales_category, standardize
from ..operators.filters import filter_all, filter_eq, filter_in, filter_range
from ..operators.ordered import interpolate
from ..plans.transform import transform_sales
from . import CATEGORY, COPIES, GAPPY, LINES, copies, gappy, lines, query, rounded, sales

_CALENDAR = """CAST(year("Date") AS INTEGER) AS "year", CAST(month("Date") AS INTEGER) AS "month",
       dayname("Date") AS day_of_week, CAST(quarter("Date") AS INTEGER) AS "quarter\""""
_ORDINAL = """CAST(CASE WHEN money > 0 AND money <= 30 THEN 0 WHEN money > 30 AND money <= 40 THEN 1
       WHEN money > 40 AND money <= 50 THEN 2 WHEN money > 50 THEN 3 END AS INTEGER)"""


@query("calendar_columns", f"""WITH {LINES} SELECT l_orderkey, l_partkey, l_suppkey, "Date", {_CALENDAR} FROM l""")
def q_calendar(spark, folder):
    return calendar_columns(lines(spark, folder).select("l_orderkey", "l_partkey", "l_suppkey", "Date"))


@query("sales_category", f"""WITH {GAPPY}
SELECT id, money, {CATEGORY} AS sales_category, {_ORDINAL} AS sales_category_ord FROM g""")
def q_category(spark, folder):
    return sales_category(gappy(spark, folder).select("id", "money"))


@query("bin_column", """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_totalprice > 0 AND o_totalprice <= 50000 THEN 'small'
            WHEN o_totalprice > 50000 AND o_totalprice <= 200000 THEN 'medium'
            WHEN o_totalprice > 200000 AND o_totalprice <= 1000000 THEN 'large' END AS band,
       CAST(CASE WHEN o_totalprice > 0 AND o_totalprice <= 50000 THEN 0
            WHEN o_totalprice > 50000 AND o_totalprice <= 200000 THEN 1
            WHEN o_totalprice > 200000 AND o_totalprice <= 1000000 THEN 2 END AS INTEGER) AS band_ord
FROM orders""")
def q_bins(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_totalprice")
    return bin_column(orders, "o_totalprice", [0, 50000, 200000, 1000000], ["small", "medium", "large"], "band")


@query("parse_date", """SELECT event_id AS id, date_trunc('second', ts) AS parsed,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS lenient FROM events""")
def q_parse_date(spark, folder):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("coffee_name") == "error", "no date").otherwise(text)
    return sales(spark, folder).select(
        "id",
        parse_date(text, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("parsed"),
        parse_date(broken, strict=False).cast("timestamp_ntz").alias("lenient"))


@query("to_day", "SELECT event_id AS id, CAST(ts AS DATE) AS day FROM events")
def q_to_day(spark, folder):
    return sales(spark, folder).select("id", to_day(F.col("ts")).alias("day"))


@query("to_month", f"""WITH {LINES}
SELECT l_orderkey, l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS "month" FROM l""")
def q_to_month(spark, folder):
    return lines(spark, folder).select("l_orderkey", "l_partkey", to_month(F.col("Date")).alias("month"))


@query("format_date", "SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS label FROM events")
def q_format_date(spark, folder):
    return sales(spark, folder).select("id", format_date(F.col("ts")).alias("label"))


@query("standardize", f"""WITH {GAPPY},
m AS (SELECT avg(money) AS am, stddev_pop(money) AS sm, avg(hour_of_day) AS ah, stddev_pop(hour_of_day) AS sh
      FROM g WHERE money IS NOT NULL AND hour_of_day IS NOT NULL)
SELECT id, round((money - am) / sm, 6) AS money_scaled,
       round(CASE WHEN money IS NOT NULL THEN (hour_of_day - ah) / sh END, 6) AS hour_of_day_scaled FROM g, m""")
def q_standardize(spark, folder):
    scaled = standardize(gappy(spark, folder).select("id", "money", "hour_of_day"), ["money", "hour_of_day"])
    return rounded(scaled.drop("money", "hour_of_day"), 6, "money_scaled", "hour_of_day_scaled")


@query("filter_range", f"WITH {GAPPY} SELECT id, money FROM g WHERE money BETWEEN 30 AND 50")
def q_filter_range(spark, folder):
    return filter_range(gappy(spark, folder).select("id", "money"), "money", 30, 50)


@query("filter_in", f"""WITH {GAPPY} SELECT id, coffee_name FROM g
WHERE coffee_name IN ('view', 'click') OR coffee_name IS NULL""")
def q_filter_in(spark, folder):
    return filter_in(gappy(spark, folder).select("id", "coffee_name"), "coffee_name", ["view", "click", None])


@query("filter_eq", f"WITH {GAPPY} SELECT id, coffee_name FROM g WHERE coffee_name = 'purchase'")
def q_filter_eq(spark, folder):
    return filter_eq(gappy(spark, folder).select("id", "coffee_name"), "coffee_name", "purchase")


@query("filter_all", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_linestatus = 'F'""")
def q_filter_all(spark, folder):
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    kept = filter_all(table, {
        "l_quantity": (10, 20), "l_returnflag": ["A", "R"], "l_linestatus": "F", "no_such_column": 1})
    return kept.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("drop_missing", f"WITH {GAPPY} SELECT * FROM g WHERE money IS NOT NULL AND coffee_name IS NOT NULL")
def q_drop_missing(spark, folder):
    return drop_missing(gappy(spark, folder))


@query("remove_outliers_iqr", f"""WITH {GAPPY},
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM g)
SELECT id, money FROM g, b WHERE money BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def q_remove_outliers(spark, folder):
    return remove_outliers_iqr(gappy(spark, folder).select("id", "money"))


@query("fill_median", f"""WITH {GAPPY}
SELECT id, coalesce(money, (SELECT median(money) FROM g)) AS money, coffee_name FROM g""")
def q_fill_median(spark, folder):
    return fill_median(gappy(spark, folder).select("id", "money", "coffee_name"))


@query("fill_mode", f"""WITH {GAPPY},
m AS (SELECT coffee_name AS v FROM g WHERE coffee_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT id, money, coalesce(coffee_name, (SELECT v FROM m)) AS coffee_name FROM g""")
def q_fill_mode(spark, folder):
    return fill_mode(gappy(spark, folder).select("id", "money", "coffee_name"))


@query("interpolate", f"""WITH {GAPPY},
n AS (SELECT id, ts, coffee_name, money, row_number() OVER (ORDER BY ts, id) AS i FROM g),
p AS (SELECT *, CASE WHEN money IS NOT NULL THEN i END AS j FROM n),
w AS (SELECT id, coffee_name, money, i,
        last_value(money IGNORE NULLS) OVER a AS v0, last_value(j IGNORE NULLS) OVER a AS i0,
        first_value(money IGNORE NULLS) OVER b AS v1, first_value(j IGNORE NULLS) OVER b AS i1
      FROM p WINDOW a AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    b AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT id, coffee_name, round(CASE WHEN money IS NOT NULL THEN money WHEN i0 IS NULL THEN NULL
       WHEN i1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (i - i0) / (i1 - i0) END, 6) AS money FROM w""")
def q_interpolate(spark, folder):
    table = gappy(spark, folder).select("id", "ts", "coffee_name", "money")
    return rounded(interpolate(table, ["money"], ["ts", "id"]), 6, "money").drop("ts")


@query("clean_drop", f"""WITH {COPIES}
SELECT DISTINCT * FROM d WHERE money IS NOT NULL AND coffee_name IS NOT NULL""")
def q_clean_drop(spark, folder):
    return clean(copies(spark, folder))


@query("clean_fill", f"""WITH {COPIES}, u AS (SELECT DISTINCT * FROM d),
m AS (SELECT coffee_name AS v FROM u WHERE coffee_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT * REPLACE (coalesce(money, (SELECT median(money) FROM u)) AS money,
                  coalesce(coffee_name, (SELECT v FROM m)) AS coffee_name) FROM u""")
def q_clean_fill(spark, folder):
    return clean(copies(spark, folder), handle_missing="fill")


@query("clean_interpolate", f"""WITH {COPIES}, u AS (SELECT DISTINCT * FROM d),
n AS (SELECT *, row_number() OVER (ORDER BY ts, id) AS i FROM u),
p AS (SELECT *, CASE WHEN money IS NOT NULL THEN i END AS j FROM n),
w AS (SELECT *,
        last_value(money IGNORE NULLS) OVER a AS v0, last_value(j IGNORE NULLS) OVER a AS i0,
        first_value(money IGNORE NULLS) OVER b AS v1, first_value(j IGNORE NULLS) OVER b AS i1
      FROM p WINDOW a AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    b AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT * EXCLUDE (i, j, v0, i0, v1, i1) REPLACE (round(CASE WHEN money IS NOT NULL THEN money WHEN i0 IS NULL THEN NULL
       WHEN i1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (i - i0) / (i1 - i0) END, 6) AS money) FROM w""")
def q_clean_interpolate(spark, folder):
    table = clean(copies(spark, folder), handle_missing="interpolate", order_by=["ts", "id"])
    return rounded(table, 6, "money")


@query("transform_sales", f"""WITH {COPIES},
u AS (SELECT DISTINCT * FROM d WHERE money IS NOT NULL AND coffee_name IS NOT NULL),
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM u)
SELECT u.*, {_CALENDAR}, {CATEGORY} AS sales_category,
       {_ORDINAL} AS sales_category_ord
FROM u, b WHERE money BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def q_transform(spark, folder):
    return transform_sales(copies(spark, folder))
