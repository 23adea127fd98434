"""Deterministic sample sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.draws import unit
from ..schema import SALES_SCHEMA, q

# Cycles of the sample table.
SAMPLE_HOURS = [10, 12, 13, 15, 16]
SAMPLE_PAYMENTS = ["card", "cash"]
SAMPLE_PRICES = [38.7, 28.9, 33.8, 25.5, 42.0]
SAMPLE_PRODUCTS = ["Latte", "Americano", "Hot Chocolate", "Cappuccino", "Espresso"]
SAMPLE_PERIODS = ["Morning", "Afternoon", "Evening"]
SAMPLE_WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri"]
SAMPLE_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May"]
SAMPLE_START = "2024-01-01"
SAMPLE_START_HOUR = 8


def _cycle(index: Column, values: list) -> Column:
    position = F.pmod(index, F.lit(len(values))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def sales_of_index(df: DataFrame, index: str) -> DataFrame:
    """One sample sale per row of ``df``, set by its 0-based ``index`` column.

    Days advance by one and hours by one per row; the cycles are independent of
    the date, so labels and dates do not agree with each other.
    """
    i = F.col(q(index)).cast("long")
    five = F.pmod(i, F.lit(5)).cast("long") + 1
    hour = F.pmod(i + SAMPLE_START_HOUR, F.lit(24)).cast("int")
    columns = {
        "hour_of_day": _cycle(i, SAMPLE_HOURS).cast("long"),
        "cash_type": _cycle(i, SAMPLE_PAYMENTS),
        "money": _cycle(i, SAMPLE_PRICES),
        "coffee_name": _cycle(i, SAMPLE_PRODUCTS),
        "Time_of_Day": _cycle(i, SAMPLE_PERIODS),
        "Weekday": _cycle(i, SAMPLE_WEEKDAYS),
        "Month_name": _cycle(i, SAMPLE_MONTHS),
        "Weekdaysort": five,
        "Monthsort": five,
        "Date": F.date_add(F.lit(SAMPLE_START).cast("date"), i.cast("int")),
        "Time": F.format_string("%02d:00:00", hour),
    }
    return df.select(i.alias("id"), *[columns[f.name].alias(f.name) for f in SALES_SCHEMA.fields])


def synth_sales(spark: SparkSession, n: int = 100) -> DataFrame:
    return sales_of_index(spark.range(n), "id")


# A livelier table: shares of a thousand sales, by which a uniform draw is turned into a value.
SEASON = [70, 68, 76, 80, 84, 88, 82, 78, 86, 92, 96, 100]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
FIRST_HOUR = 7
HOURS = [60, 110, 130, 100, 70, 60, 50, 40, 45, 60, 90, 75, 50, 30, 20, 10]  # a peak before work and one after
PRODUCTS = [300, 250, 100, 200, 150]
YEAR = 2024
DAYS = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
PLANTED = 10     # of a thousand sales
SPREAD = 101     # prices vary by up to five in a hundred either way, in steps of one in a thousand
FACTORS = 40     # a planted sale is 4 to 8 times as dear, in steps of a tenth


def _drawn(draw: Column, shares: list[int]) -> Column:
    """0-based place in a table of shares: how many running sums the draw has passed."""
    whole, upto = sum(shares), 0
    place = F.lit(0)
    for share in shares[:-1]:
        upto += share
        place = place + (draw * whole >= upto).cast("int")
    return place


def seasonal_of_index(df: DataFrame, index: str, seed: int = 7) -> DataFrame:
    """One sale of ``YEAR`` per row with a season, weekday labels that agree with the date, peak hours and planted anomalies.

    Every value is drawn by the md5 of the seed, its own name and the index, so a row is the
    same in any table and at any partition count.  ``planted`` is the truth that detectors
    can be held against: about ten sales of a thousand cost several times their price.
    """
    i = F.col(q(index)).cast("long")

    def draw(name: str) -> Column:
        return unit(F.lit(seed), F.lit(name), i)

    drawn = df.select(
        i.alias("id"), _drawn(draw("month"), SEASON).alias("__month"), draw("day").alias("__day"),
        _drawn(draw("hour"), HOURS).alias("__hour"), F.floor(draw("minute") * 60).cast("int").alias("__minute"),
        _drawn(draw("product"), PRODUCTS).alias("__product"), F.floor(draw("price") * SPREAD).cast("long").alias("__price"),
        F.floor(draw("factor") * FACTORS).cast("long").alias("__factor"), (draw("planted") * 1000 < PLANTED).alias("planted"),
        F.when(draw("payment") * 10 < 7, "card").otherwise("cash").alias("cash_type"))
    listed = lambda values, place: F.element_at(F.array(*[F.lit(v) for v in values]), F.col(place) + 1)
    day = F.make_date(F.lit(YEAR), F.col("__month") + 1, (F.floor(F.col("__day") * listed(DAYS, "__month")) + 1).cast("int"))
    hour = F.col("__hour") + FIRST_HOUR
    # whole tenths of a thousandth of a cent, then whole cents
    cents = listed([round(p * 100) for p in SAMPLE_PRICES], "__product").cast("long") * (F.col("__price") + 950)
    cents = F.when(F.col("planted"), cents * (F.col("__factor") + 40)).otherwise(cents * 10)
    columns = {
        "hour_of_day": hour.cast("long"),
        "cash_type": F.col("cash_type"),
        "money": F.floor(cents / 10_000).cast("double") / 100,
        "coffee_name": listed(SAMPLE_PRODUCTS, "__product"),
        "Time_of_Day": F.when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening"),
        "Weekday": F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday("__date") + 1),
        "Month_name": listed(MONTHS, "__month"),
        "Weekdaysort": (F.weekday("__date") + 1).cast("long"),
        "Monthsort": (F.col("__month") + 1).cast("long"),
        "Date": F.col("__date"),
        "Time": F.format_string("%02d:%02d:00", hour, F.col("__minute")),
    }
    return drawn.withColumn("__date", day).select("id", *[columns[f.name].alias(f.name) for f in SALES_SCHEMA.fields], "planted")


def synth_seasonal(spark: SparkSession, n: int = 1000, seed: int = 7) -> DataFrame:
    return seasonal_of_index(spark.range(n), "id", seed)
