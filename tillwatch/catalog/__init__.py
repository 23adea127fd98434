"""Registered queries: every operator over the driver tables, with its SQL twin.

All queries read their whole tables.  The tables hold neither gaps nor copies,
so ``gappy`` blanks some cells and ``copies`` repeats the morning rows, the same
way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.views import event_sales, order_line_sales

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SALES = """s AS (
  SELECT event_id AS id, ts, CAST(hour(ts) AS BIGINT) AS hour_of_day,
         CASE WHEN user_id % 2 = 0 THEN 'card' ELSE 'cash' END AS cash_type,
         value AS money, event_type AS coffee_name,
         CASE WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 18 THEN 'Afternoon' ELSE 'Evening' END AS "Time_of_Day",
         strftime(ts, '%a') AS "Weekday", strftime(ts, '%b') AS "Month_name",
         CAST(isodow(ts) AS BIGINT) AS "Weekdaysort", CAST(month(ts) AS BIGINT) AS "Monthsort",
         CAST(ts AS DATE) AS "Date", strftime(ts, '%H:%M:%S') AS "Time"
  FROM events)"""

GAPPY = SALES + """,
g AS (
  SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN NULL ELSE money END AS money,
                    CASE WHEN id % 11 = 0 THEN NULL ELSE coffee_name END AS coffee_name)
  FROM s)"""

COPIES = GAPPY + """,
d AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE "Time_of_Day" = 'Morning')"""

CATEGORY = """CASE WHEN money > 0 AND money <= 30 THEN 'Baixa' WHEN money > 30 AND money <= 40 THEN 'Média'
       WHEN money > 40 AND money <= 50 THEN 'Alta' WHEN money > 50 THEN 'Muito Alta' END"""

LINES = """l AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice AS money,
         l_quantity AS quantity, l_returnflag AS coffee_name, CAST(l_shipdate AS DATE) AS "Date"
  FROM lineitem)"""


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function
    return register


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return event_sales(spark, folder)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return order_line_sales(spark, folder)


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder)
    return table.withColumns({
        "money": F.when(F.col("id") % 7 != 0, F.col("money")),
        "coffee_name": F.when(F.col("id") % 11 != 0, F.col("coffee_name")),
    })


def copies(spark: SparkSession, folder: str) -> DataFrame:
    table = gappy(spark, folder)
    return table.unionByName(table.filter(F.col("Time_of_Day") == "Morning"))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums of doubles differ in the last bits between engines and partitionings."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


from . import inout, rows, groups, ordering, detectors, reports  # noqa: E402,F401  (registration)
