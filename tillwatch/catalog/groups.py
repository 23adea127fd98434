"""Aggregations, pivots, bounds and joins to group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregate import (
    Mergeable, aggregate, aggregate_categories, count_distinct_rows, group_stats, join_group_stats)
from ..functions.bins import SALES_LABELS
from ..operators.features import sales_category
from ..operators.quantiles import exact_quantiles, grouped_quantile, median_abs_dev, quantile_bounds
from ..operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, merged_bounds, merged_distinct, merged_quantiles, merged_summary, sketch_days)
from ..operators.tables import describe, histogram, pivot_map, pivot_rows, pivot_sum, product_month_long
from ..session import materialize
from . import CATEGORY, GAPPY, LINES, gappy, lines, query, rounded


@query("aggregate", f"""WITH {GAPPY}
SELECT coffee_name, "Time_of_Day",
       round(coalesce(sum(money), 0), 2) AS money_sum, round(avg(money), 6) AS money_mean,
       min(money) AS money_min, max(money) AS money_max, count(money) AS money_count, count(*) AS money_size,
       round(stddev_samp(money), 6) AS money_std, round(var_samp(money), 4) AS money_var,
       round(stddev_samp(money) / sqrt(count(money)), 6) AS money_sem,
       count(DISTINCT money) AS money_nunique, round(skewness(money), 6) AS money_skew,
       median(money) AS money_median, quantile_cont(money, 0.5) AS money_quantile,
       count(DISTINCT hour_of_day) AS hour_of_day_nunique, CAST(sum(hour_of_day) AS BIGINT) AS hour_of_day_sum
FROM g WHERE coffee_name IS NOT NULL GROUP BY 1, 2""")
def q_aggregate(spark, folder):
    table = aggregate(gappy(spark, folder), ["coffee_name", "Time_of_Day"], {
        "money": ["sum", "mean", "min", "max", "count", "size", "std", "var", "sem", "nunique", "skew",
                  "median", "quantile"],
        "hour_of_day": ["nunique", "sum"],
    })
    table = rounded(table, 6, "money_mean", "money_std", "money_sem", "money_skew")
    return rounded(rounded(table, 2, "money_sum"), 4, "money_var")


@query("aggregate_first_last", f"""WITH {GAPPY}
SELECT coffee_name, arg_min(money, (ts, id)) FILTER (money IS NOT NULL) AS money_first,
       arg_max(money, (ts, id)) FILTER (money IS NOT NULL) AS money_last
FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_first_last(spark, folder):
    return aggregate(gappy(spark, folder), ["coffee_name"], {"money": ["first", "last"]}, order_by=["ts", "id"])


@query("aggregate_product", """
SELECT l_returnflag, round(exp(sum(ln(1 + l_tax / 100000))), 6) AS growth_prod FROM lineitem GROUP BY 1""")
def q_product(spark, folder):
    """Factors close to one, so that the product stays in range on larger tables."""
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    table = table.select("l_returnflag", (1 + F.col("l_tax") / 100000).alias("growth"))
    return rounded(aggregate(table, ["l_returnflag"], {"growth": ["prod"]}), 6, "growth_prod")


_SPREAD = Mergeable(
    "spread",
    partial=lambda values: (values.min(), values.max()) if len(values) else None,
    merge=lambda states: (min(s[0] for s in states if s), max(s[1] for s in states if s)) if any(states) else None,
    finish=lambda state: None if state is None else float(state[1] - state[0]),
)


@query("aggregate_callable", f"""WITH {GAPPY}
SELECT coffee_name, max(money) - min(money) AS money_spread, max(money) + min(money) AS money_ends,
       max(money) / min(money) AS money_ratio
FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_callable(spark, folder):
    """A mergeable pandas aggregate and two Column functions; a ratio to zero is infinite, that of zeros NaN, as in the SQL."""
    def ends(x):
        return F.max(x) + F.min(x)

    def ratio(x):
        return F.when(F.min(x) == 0, F.max(x) * F.lit(float("inf"))).otherwise(F.max(x) / F.min(x))

    return aggregate(gappy(spark, folder), ["coffee_name"], {"money": [_SPREAD, ends, ratio]})


@query("aggregate_categories", f"""WITH {GAPPY},
c AS (SELECT *, {CATEGORY} AS sales_category FROM g),
k AS (SELECT DISTINCT coffee_name FROM c WHERE coffee_name IS NOT NULL AND sales_category IS NOT NULL)
SELECT v.level AS sales_category, k.coffee_name, round(coalesce(sum(money), 0), 2) AS money_sum,
       count(money) AS money_count, round(avg(money), 6) AS money_mean
FROM (VALUES ('Baixa'), ('Média'), ('Alta'), ('Muito Alta'), ('Rara')) v(level), k
LEFT JOIN c ON c.sales_category = v.level AND c.coffee_name = k.coffee_name GROUP BY 1, 2""")
def q_aggregate_categories(spark, folder):
    """The last level never occurs and is still shown for every product."""
    table = aggregate_categories(
        sales_category(gappy(spark, folder)), ["sales_category", "coffee_name"], {"money": ["sum", "count", "mean"]},
        levels=[*SALES_LABELS, "Rara"])
    return rounded(rounded(table, 2, "money_sum"), 6, "money_mean")


def _cells(values: list[str], key: str, alias: bool = True) -> str:
    return ", ".join(
        f"""round(coalesce(sum(CASE WHEN {key} = '{v}' THEN money END), 0), 2) AS "{v}\"""" for v in values)


_PERIODS = ["Afternoon", "Evening", "Morning"]
_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pivot_sum", f"""WITH {LINES}
SELECT coffee_name, {", ".join(
    f'round(coalesce(sum(CASE WHEN year("Date") = {y} THEN money END), -1), 2) AS "{y}"' for y in range(1992, 2002))}
FROM l GROUP BY 1""")
def q_pivot(spark, folder):
    """The years before 1995 are empty and show the fill value."""
    table = lines(spark, folder).withColumn("year", F.year("Date"))
    result = pivot_sum(table, "coffee_name", "year", "money", fill_value=-1, pivot_on=list(range(1992, 2002)))
    return rounded(result, 2, *[str(y) for y in range(1992, 2002)])


@query("pivot_product_period", f"""WITH {GAPPY}
SELECT coffee_name, {_cells(_PERIODS, '"Time_of_Day"')} FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_pivot_period(spark, folder):
    return rounded(pivot_sum(gappy(spark, folder), "coffee_name", "Time_of_Day", "money"), 2, *_PERIODS)


@query("pivot_weekday_product", f"""WITH {GAPPY}
SELECT "Weekday", {_cells(_TYPES, 'coffee_name')} FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_pivot_weekday(spark, folder):
    table = pivot_sum(gappy(spark, folder), "Weekday", "coffee_name", "money")
    return rounded(table, 2, *[c for c in table.columns if c != "Weekday"])


@query("heatmap_product_month", f"""WITH {LINES},
m AS (SELECT DISTINCT strftime("Date", '%Y-%m') AS "month" FROM l), p AS (SELECT DISTINCT coffee_name FROM l)
SELECT p.coffee_name, m."month", round(coalesce(sum(l.money), 0), 2) AS sales
FROM p CROSS JOIN m LEFT JOIN l ON l.coffee_name = p.coffee_name AND strftime(l."Date", '%Y-%m') = m."month"
GROUP BY 1, 2""")
def q_heatmap(spark, folder):
    """Long form: every product with every month present."""
    return rounded(product_month_long(lines(spark, folder)), 2, "sales")


@query("sales_histogram", f"""WITH {GAPPY},
e AS (SELECT min(money) AS mn, max(money) AS mx, (max(money) - min(money)) / 30 AS w FROM g),
b AS (SELECT CAST(i AS INTEGER) AS bin, mn + (i - 1) * w AS lo, CASE WHEN i = 30 THEN mx ELSE mn + i * w END AS hi
      FROM range(1, 31) r(i), e)
SELECT bin, round(lo, 6) AS bin_start, round(hi, 6) AS bin_end, count(money) AS "count"
FROM b LEFT JOIN g ON money >= lo AND (money < hi OR bin = 30 AND money = hi) GROUP BY ALL""")
def q_histogram(spark, folder):
    return rounded(histogram(gappy(spark, folder)), 6, "bin_start", "bin_end")


_DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS "min", quantile_cont({c}, 0.25) AS q25,
  CAST(median({c}) AS DOUBLE) AS "median", quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS "max" FROM g"""


@query("describe", f"WITH {GAPPY} {_DESCRIBE.format(c='money')} UNION ALL {_DESCRIBE.format(c='hour_of_day')}")
def q_describe(spark, folder):
    return rounded(describe(gappy(spark, folder), ["money", "hour_of_day"]), 6, "mean", "std")


_BOUNDS = """SELECT '{c}' AS "column", q1, q3, round(q3 - q1, 6) AS iqr, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
  round(q3 + 1.5 * (q3 - q1), 6) AS upper
  FROM (SELECT round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.75), 6) AS q3 FROM l)"""


@query("quantile_bounds", f"WITH {LINES} {_BOUNDS.format(c='money')} UNION ALL {_BOUNDS.format(c='quantity')}")
def q_bounds(spark, folder):
    return rounded(quantile_bounds(lines(spark, folder), ["money", "quantity"]), 6, "q1", "q3", "iqr", "lower", "upper")


@query("median_abs_dev", f"""WITH {LINES}
SELECT 'money' AS "column", round(median(money), 6) AS "median", round(mad(money), 6) AS mad FROM l""")
def q_mad(spark, folder):
    return rounded(median_abs_dev(lines(spark, folder), ["money"]), 6, "median", "mad")


@query("grouped_median", f"""WITH {LINES}
SELECT coffee_name, round(median(money), 6) AS money_median FROM l GROUP BY 1""")
def q_grouped_median(spark, folder):
    """The path for groups too large for one buffer, taken here from 1,000 rows on."""
    table = grouped_quantile(lines(spark, folder), ["coffee_name"], "money", 0.5, "money_median", direct_rows=1000)
    return rounded(table, 6, "money_median")


@query("group_stats", f"""WITH {GAPPY}
SELECT coffee_name, round(avg(money), 6) AS mean, round(stddev_samp(money), 6) AS std, count(money) AS "count",
       min(money) AS "min", max(money) AS "max" FROM g WHERE coffee_name IS NOT NULL GROUP BY 1""")
def q_group_stats(spark, folder):
    return rounded(group_stats(gappy(spark, folder), ["coffee_name"], "money"), 6, "mean", "std")


_JOINED = """t AS (SELECT coffee_name, avg(money) AS mean, stddev_samp(money) AS std, count(money) AS "count"
      FROM g WHERE coffee_name IS NOT NULL GROUP BY 1)
SELECT g.id, g.coffee_name, g.money, round(t.mean, 6) AS mean, round(t.std, 6) AS std, t."count"
FROM g JOIN t USING (coffee_name)"""


@query("join_group_stats", f"WITH {GAPPY}, {_JOINED}")
def q_join_stats(spark, folder):
    table = gappy(spark, folder).select("id", "coffee_name", "money")
    return rounded(join_group_stats(table, ["coffee_name"], "money"), 6, "mean", "std")


@query("count_distinct", f"""WITH {GAPPY}
SELECT count(DISTINCT coffee_name) AS coffee_name, count(DISTINCT money) AS money,
       count(DISTINCT "Date") AS "Date" FROM g""")
def q_count_distinct(spark, folder):
    return count_distinct_rows(gappy(spark, folder), ["coffee_name", "money", "Date"])


_WHOLE = "CAST(l_quantity > 25 AS INTEGER)"


@query("quantile_ties", f"""SELECT 'whole' AS "column", quantile_cont({_WHOLE}, 0.25)::DOUBLE AS q1,
       quantile_cont({_WHOLE}, 0.75)::DOUBLE AS q3 FROM lineitem UNION ALL
SELECT 'quantity', quantile_cont(l_quantity, 0.25)::DOUBLE, quantile_cont(l_quantity, 0.75)::DOUBLE FROM lineitem""")
def q_quantile_ties(spark, folder):
    """Two values over all rows, and fifty."""
    table = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_quantity") > 25).cast("int").alias("whole"), F.col("l_quantity").alias("quantity"))
    return quantile_bounds(table, ["whole", "quantity"]).select("column", "q1", "q3")


@query("grouped_quantile_ties", f"""SELECT l_returnflag, l_linestatus, quantile_cont({_WHOLE}, 0.5)::DOUBLE AS middle
FROM lineitem GROUP BY 1, 2""")
def q_grouped_quantile_ties(spark, folder):
    """The way for groups above the size that one task may hold, at any table size."""
    table = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_returnflag", "l_linestatus", (F.col("l_quantity") > 25).cast("int").alias("whole"))
    return grouped_quantile(table, ["l_returnflag", "l_linestatus"], "whole", 0.5, "middle", direct_rows=1)


@query("pivot_map", """SELECT l_returnflag, l_partkey AS label, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY 1, 2""")
def q_pivot_map(spark, folder):
    """Every part as a label: far more than columns allow."""
    table = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_returnflag", "l_partkey", "l_extendedprice")
    return rounded(pivot_rows(pivot_map(table, "l_returnflag", "l_partkey", "l_extendedprice"), "l_returnflag"), 2, "value")


def _stored_days(table, date, numeric, distinct):
    return materialize(sketch_days(table, date, numeric, distinct), "sketches")


_PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@query("sketched_quantiles", f"""WITH {LINES}, w AS (SELECT year("Date") AS year, quarter("Date") AS quarter, money FROM l)
SELECT CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter, prob, count(*) AS n, min(money) AS min, max(money) AS max, true AS near
FROM w, (SELECT unnest({_PROBS}::DOUBLE[]) AS prob) GROUP BY ALL""")
def q_sketched_quantiles(spark, folder):
    """Quantiles of every quarter from stored days; ``near``: the exact rank is within the stated error."""
    table = lines(spark, folder).select("Date", "money")
    by = [F.year("day").alias("year"), F.quarter("day").alias("quarter")]
    found = merged_quantiles(_stored_days(table, "Date", ["money"], []), "money", _PROBS, by)
    rows = table.select(F.year("Date").alias("year"), F.quarter("Date").alias("quarter"), "money").join(found, ["year", "quarter"])
    keys = ["year", "quarter", "prob", "n", "min", "max"]
    ranks = rows.groupBy(*keys).agg(F.count_if(F.col("money") < F.col("value")).alias("below"), F.count_if(F.col("money") <= F.col("value")).alias("upto"))
    # one rank more on either side, as a small quarter has no rank closer
    slack, goal = F.col("n") * RANK_ERROR + 1, F.col("prob") * F.col("n")
    return ranks.select(*keys, ((F.col("below") <= goal + slack) & (F.col("upto") >= goal - slack)).alias("near"))


@query("sketched_bounds", "SELECT count(*) AS n, true AS near FROM lineitem")
def q_sketched_bounds(spark, folder):
    """Quartile bounds of all days against the exact ones: each lies between exact quantiles a hundredth of the rows away."""
    table = lines(spark, folder).select("Date", "money")
    found = merged_bounds(_stored_days(table, "Date", ["money"], []), "money")
    low1, high1, low3, high3 = (quantile_at(table, "money", p) for p in (0.25 - RANK_ERROR, 0.25 + RANK_ERROR, 0.75 - RANK_ERROR, 0.75 + RANK_ERROR))
    return found.select("n", (F.col("q1").between(low1, high1) & F.col("q3").between(low3, high3) & (F.col("upper") > F.col("q3"))).alias("near"))


def quantile_at(table, column, prob):
    return exact_quantiles(table, [column], [prob])[column][0]


@query("sketched_distinct", f"""WITH {LINES}
SELECT CAST(year("Date") AS INTEGER) AS year, count(DISTINCT l_partkey) AS exact, true AS near FROM l GROUP BY 1""")
def q_sketched_distinct(spark, folder):
    """Distinct parts of every year from stored days; ``near``: within four standard errors."""
    table = lines(spark, folder).select("Date", "l_partkey")
    found = merged_distinct(_stored_days(table, "Date", [], ["l_partkey"]), "l_partkey", [F.year("day").alias("year")])
    exact = table.groupBy(F.year("Date").alias("year")).agg(F.count_distinct("l_partkey").alias("exact"))
    return exact.join(found, "year").select("year", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact") + 1).alias("near"))


@query("sketched_summary", f"""WITH {GAPPY}
SELECT CAST(isodow("Date") AS INTEGER) AS weekday, round(coalesce(sum(money), 0), 2) AS total_sales, count(*) AS total_transactions,
       round(avg(money), 6) AS average_transaction, count(DISTINCT coffee_name) AS unique_products FROM g GROUP BY 1""")
def q_sketched_summary(spark, folder):
    """The sales summary of every weekday from stored days; so few products are counted exactly."""
    days = _stored_days(gappy(spark, folder).select("Date", "money", "coffee_name"), "Date", ["money"], ["coffee_name"])
    table = merged_summary(days, by=[(F.weekday("day") + 1).alias("weekday")])
    return rounded(rounded(table, 2, "total_sales"), 6, "average_transaction")
