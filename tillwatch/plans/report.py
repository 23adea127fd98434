"""Sales summaries, chart tables and the workbook tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import format_date, month_label, to_day, to_month
from ..operators.aggregate import aggregate, aggregate_categories, drop_null_keys
from ..operators.tables import histogram, long_form, product_month
from ..session import materialize

TOP = 10


def _total():
    return F.coalesce(F.sum("money"), F.lit(0.0))


def sales_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``metric, value`` rows: total, transactions, average, distinct products; 0 for an absent column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    money, product = "money" in df.columns, "coffee_name" in df.columns
    row = df.agg(
        (_total() if money else F.lit(0.0)).alias("total_sales"),
        F.count(F.lit(1)).alias("total_transactions"),
        (F.avg("money") if money else F.lit(0.0)).alias("average_transaction"),
        (count("coffee_name") if product else F.lit(0)).alias("unique_products"),
    )
    return long_form(row, {c: F.col(c) for c in row.columns})


def date_range(df: DataFrame, column: str = "Date") -> DataFrame:
    """First and last day as text (null for an empty table)."""
    return df.agg(format_date(F.min(column)).alias("start"), format_date(F.max(column)).alias("end"))


def monthly_sales(df: DataFrame) -> DataFrame:
    """Sum per month present, ascending; ``month`` is the month's first day."""
    keyed = df.select(to_month(F.col("Date")).alias("month"), "money")
    return drop_null_keys(keyed, ["month"]).groupBy("month").agg(_total().alias("sales")).orderBy("month")


def daily_sales(df: DataFrame) -> DataFrame:
    keyed = df.select(to_day(F.col("Date")).alias("day"), "money")
    return drop_null_keys(keyed, ["day"]).groupBy("day").agg(_total().alias("sales")).orderBy("day")


def top_products(df: DataFrame, n: int = TOP) -> DataFrame:
    """Products by summed sales, descending, name on ties; a bounded top-k, not a sort."""
    totals = drop_null_keys(df, ["coffee_name"]).groupBy("coffee_name").agg(_total().alias("sales"))
    return totals.orderBy(F.col("sales").desc(), F.col("coffee_name")).limit(n)


def sales_by_period(df: DataFrame) -> DataFrame:
    return aggregate(df, ["Time_of_Day"], {"money": ["sum", "count"]})


def sales_by_category(df: DataFrame) -> DataFrame:
    return aggregate_categories(df, ["sales_category"], {"money": ["sum", "count"]})


def stats_by_product(df: DataFrame) -> DataFrame:
    return aggregate(df, ["coffee_name"], {"money": ["sum", "mean", "count"]})


CUBE_KEYS = ["Date", "coffee_name", "Time_of_Day", "sales_category"]


def report_cube(df: DataFrame) -> DataFrame:
    """Sums and counts per day, product, day period and category, in one pass.

    ``money`` holds the partial sum, so tables that only add amounts read the
    cube exactly as they would read the sales; ``n`` and ``rows`` weigh means
    and counts.  Missing keys are kept as groups of their own.
    """
    keys = [c for c in CUBE_KEYS if c in df.columns]
    measures = [F.count(F.lit(1)).alias("rows")]
    if "money" in df.columns:
        measures += [F.sum("money").alias("money"), F.count("money").alias("n")]
    day = {"Date": to_day(F.col("Date"))} if "Date" in keys else {}
    return df.withColumns(day).groupBy(*keys).agg(*measures) if keys else df.agg(*measures)


def _cube_kpi(cube: DataFrame) -> DataFrame:
    money, product = "money" in cube.columns, "coffee_name" in cube.columns
    row = cube.agg(
        (_total() if money else F.lit(0.0)).alias("total_sales"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_transactions"),
        (F.try_divide(F.sum("money"), F.sum("n")) if money else F.lit(0.0)).alias("average_transaction"),
        (F.count_distinct("coffee_name") if product else F.lit(0)).alias("unique_products"),
    )
    return long_form(row, {c: F.col(c) for c in row.columns})


def _cube_stats(cube: DataFrame, key: str, mean: bool) -> DataFrame:
    measures = [_total().alias("money_sum"), F.sum("n").alias("money_count")]
    if mean:
        measures.insert(1, F.try_divide(F.sum("money"), F.sum("n")).alias("money_mean"))
    return drop_null_keys(cube, [key]).groupBy(key).agg(*measures).orderBy(key)


def complete_report(df: DataFrame, bins: int = 30) -> dict[str, DataFrame]:
    """Every report table the columns allow.

    The table is read once into the cube, which is written; only the histogram
    goes back to the amounts.
    """
    cube = materialize(report_cube(df), "report-cube")
    tables = {"kpi": _cube_kpi(cube)}
    money, product, date, period, category = (
        c in df.columns for c in ("money", "coffee_name", "Date", "Time_of_Day", "sales_category"))
    if date:
        tables["date_range"] = date_range(cube)
    if date and money:
        tables["monthly"] = monthly_sales(cube)
        tables["daily"] = daily_sales(cube)
    if product and money:
        tables["top_products"] = top_products(cube)
        tables["by_product"] = _cube_stats(cube, "coffee_name", mean=True)
    if money:
        tables["histogram"] = histogram(df, "money", bins)
    if product and date and money:
        tables["heatmap"] = product_month(cube)
    if money and period:
        tables["by_period"] = _cube_stats(cube, "Time_of_Day", mean=False)
    if money and category:
        counted = aggregate_categories(cube, ["sales_category"], {"money": ["sum"], "n": ["sum"]})
        tables["by_category"] = counted.withColumnRenamed("n_sum", "money_count")
    return tables


# Sheet names, column heads and metric labels of the workbook.
SHEET_SOURCE = "Dados_Originais"
SHEET_SUMMARY = "Resumo"
SHEET_TOP = "Top_Produtos"
SHEET_MONTHLY = "Vendas_Mensais"
SUMMARY_HEADS = ("Métrica", "Valor")
TOP_HEADS = ("Produto", "Total_Vendas")
MONTHLY_HEADS = ("Mês", "Vendas")
METRIC_LABELS = {
    "total_sales": "Total de Vendas",
    "total_transactions": "Total de Transações",
    "average_transaction": "Ticket Médio",
    "unique_products": "Produtos Únicos",
}


def report_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The workbook's tables under their sheet names; top and monthly only if their columns exist."""
    label = F.lit(None).cast("string")
    for metric, text in METRIC_LABELS.items():
        label = F.when(F.col("metric") == metric, text).otherwise(label)
    tables = {
        SHEET_SOURCE: df,
        SHEET_SUMMARY: sales_summary(df).select(
            label.alias(SUMMARY_HEADS[0]), F.col("value").alias(SUMMARY_HEADS[1])),
    }
    if {"coffee_name", "money"} <= set(df.columns):
        tables[SHEET_TOP] = top_products(df).toDF(*TOP_HEADS)
    if {"Date", "money"} <= set(df.columns):
        tables[SHEET_MONTHLY] = monthly_sales(df).select(
            month_label(F.col("month")).alias(MONTHLY_HEADS[0]), F.col("sales").alias(MONTHLY_HEADS[1]))
    return tables
