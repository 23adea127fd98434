"""Rolling windows, sorting, top-k and examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordered import rolling_mean, rolling_std, row_index, sort_by_date, temporal_anomaly
from ..operators.outliers import statistical_outliers
from ..operators.reporting import flagged_rows, head_rows, select_examples
from ..plans.report import top_products
from ..sources.views import ORDER_LINE_KEY
from . import GAPPY, LINES, SALES, gappy, lines, query, rounded, sales

_FRAME = "WINDOW w AS (ORDER BY ts, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@query("rolling_mean", f"""WITH {GAPPY}
SELECT id, money, round(CASE WHEN count(money) OVER w = 7 THEN avg(money) OVER w END, 6) AS rolling_mean
FROM g {_FRAME}""")
def q_rolling_mean(spark, folder):
    table = gappy(spark, folder).select("id", "ts", "money")
    return rounded(rolling_mean(table, "money", 7, ["ts", "id"]), 6, "rolling_mean").drop("ts")


@query("rolling_std", f"""WITH {GAPPY}
SELECT id, money, round(CASE WHEN count(money) OVER w = 7 THEN stddev_samp(money) OVER w END, 6) AS rolling_std
FROM g {_FRAME}""")
def q_rolling_std(spark, folder):
    table = gappy(spark, folder).select("id", "ts", "money")
    return rounded(rolling_std(table, "money", 7, ["ts", "id"]), 6, "rolling_std").drop("ts")


def _temporal(source: str, order: str, columns: str) -> str:
    return f"""r AS (SELECT {columns}, money, count(money) OVER w AS n, avg(money) OVER w AS a, stddev_samp(money) OVER w AS sd,
      min(money) OVER w AS mn, max(money) OVER w AS mx
      FROM {source} WINDOW w AS (ORDER BY {order} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT {columns}, money, round(CASE WHEN n = 7 THEN a END, 6) AS rolling_mean,
       round(CASE WHEN n = 7 THEN sd END, 6) AS rolling_std,
       coalesce(n = 7 AND mn < mx AND abs(money - a) > 2 * sd, false) AS temporal_anomaly FROM r"""


@query("temporal_anomaly", f"WITH {GAPPY}, " + _temporal("g", "ts, id", "id"))
def q_temporal(spark, folder):
    table = gappy(spark, folder).select("id", "ts", "money")
    result = temporal_anomaly(table, "ts", "money", ["id"])
    return rounded(result, 6, "rolling_mean", "rolling_std").drop("ts")


_LINE_KEY = ", ".join(ORDER_LINE_KEY)


@query("lines_temporal_anomaly", f"WITH {LINES}, " + _temporal("l", f'"Date", {_LINE_KEY}', _LINE_KEY))
def q_lines_temporal(spark, folder):
    """Day-long ties split by the line key."""
    table = lines(spark, folder).select(*ORDER_LINE_KEY, "Date", "money")
    result = temporal_anomaly(table, "Date", "money", ORDER_LINE_KEY)
    return rounded(result, 6, "rolling_mean", "rolling_std").drop("Date")


@query("row_index", f"""WITH {LINES}
SELECT {_LINE_KEY}, row_number() OVER (ORDER BY "Date", {_LINE_KEY}) - 1 AS row_index FROM l""")
def q_row_index(spark, folder):
    table = lines(spark, folder).select(*ORDER_LINE_KEY, "Date")
    return row_index(table, ["Date", *ORDER_LINE_KEY]).drop("Date")


@query("sort_by_date", f"WITH {GAPPY} SELECT id, \"Date\", money FROM g ORDER BY \"Date\", id")
def q_sort(spark, folder):
    return sort_by_date(gappy(spark, folder).select("id", "Date", "money"), "Date", ["id"])


_TOP = """SELECT p_brand AS coffee_name, round(sum(l_extendedprice), 2) AS sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


def _brand_sales(spark, folder):
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_partkey", F.col("l_extendedprice").alias("money"))
    parts = spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("coffee_name"))
    return items.join(parts, "l_partkey")


@query("top_products", _TOP)
def q_top(spark, folder):
    return rounded(top_products(_brand_sales(spark, folder)), 2, "sales")


@query("top_products_chart", f"""WITH {GAPPY}
SELECT coffee_name, round(sum(money), 2) AS sales FROM g WHERE coffee_name IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q_top_chart(spark, folder):
    return rounded(top_products(gappy(spark, folder)), 2, "sales")


_FLAGGED = f"""WITH {SALES},
b AS (SELECT quantile_cont(money, 0.25) AS q1, quantile_cont(money, 0.75) AS q3 FROM s),
f AS (SELECT s.*, money < q1 - 1.5 * (q3 - q1) OR money > q3 + 1.5 * (q3 - q1) AS o FROM s, b)"""


@query("select_examples", _FLAGGED + """
SELECT coffee_name, money, hour_of_day, "Date", o AS money_outlier, o AS is_outlier
FROM f WHERE o ORDER BY ts, id LIMIT 10""")
def q_examples(spark, folder):
    flagged = statistical_outliers(sales(spark, folder), ["money"])
    return select_examples(flagged, ["coffee_name", "money", "hour_of_day", "Date"], ["ts", "id"])


@query("head_examples", _FLAGGED + " SELECT id, money FROM f WHERE o ORDER BY money DESC, id LIMIT 10")
def q_head(spark, folder):
    flagged = flagged_rows(statistical_outliers(sales(spark, folder), ["money"]))
    largest = flagged.select("id", "money", (-F.col("money")).alias("key"))
    return head_rows(largest, ["key", "id"]).drop("key")
