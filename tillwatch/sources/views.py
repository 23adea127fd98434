"""Sales-shaped views over other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def sales_view(events: DataFrame) -> DataFrame:
    """The canonical sales columns over an event table, plus ``id`` and ``ts``."""
    hour = F.hour("ts")
    day = F.to_date("ts")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts"),
        hour.cast("long").alias("hour_of_day"),
        F.when(F.pmod("user_id", F.lit(2)) == 0, "card").otherwise("cash").alias("cash_type"),
        F.col("value").alias("money"),
        F.col("event_type").alias("coffee_name"),
        F.when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening").alias("Time_of_Day"),
        F.date_format(day, "EEE").alias("Weekday"),
        F.date_format(day, "MMM").alias("Month_name"),
        (F.weekday(day) + 1).cast("long").alias("Weekdaysort"),
        F.month(day).cast("long").alias("Monthsort"),
        day.alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
    )


def event_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales_view(spark.read.parquet(f"{folder}/events.parquet"))


def order_line_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The same idea over order lines: amount, quantity, product, date and a unique key."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.col("l_extendedprice").alias("money"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("coffee_name"),
        F.to_date("l_shipdate").alias("Date"),
    )


ORDER_LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
