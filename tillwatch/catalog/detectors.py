"""Detectors and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregate import join_group_stats
from ..operators.clusters import kmeans_anomaly
from ..operators.forest import isolation_forest
from ..operators.outliers import (
    outliers_iqr, outliers_modified_zscore, outliers_zscore, pattern_anomaly, statistical_outliers)
from ..operators.reporting import anomaly_report, combined_anomalies, label_flagged, split_flagged
from ..plans.detect import DetectionPlan, detect_anomalies
from ..session import materialize
from ..sources.views import ORDER_LINE_KEY
from . import GAPPY, LINES, SALES, gappy, lines, query, rounded, sales
from .model_sql import chain_sql, forest_sql, kmeans_sql

_IQR = """b AS (SELECT quantile_cont(money, 0.25) AS m1, quantile_cont(money, 0.75) AS m3,
             quantile_cont(hour_of_day, 0.25) AS h1, quantile_cont(hour_of_day, 0.75) AS h3 FROM g),
f AS (SELECT g.*,
        coalesce(money < m1 - 1.5 * (m3 - m1) OR money > m3 + 1.5 * (m3 - m1), false) AS money_outlier,
        coalesce(hour_of_day < h1 - 0.4 * (h3 - h1) OR hour_of_day > h3 + 0.4 * (h3 - h1), false) AS late
      FROM g, b)"""


@query("outliers_iqr", f"""WITH {GAPPY}, {_IQR.replace("0.4", "1.5").replace("late", "hour_of_day_outlier")}
SELECT id, money, hour_of_day, money_outlier, hour_of_day_outlier,
       money_outlier OR hour_of_day_outlier AS is_outlier FROM f""")
def q_iqr(spark, folder):
    return outliers_iqr(gappy(spark, folder).select("id", "money", "hour_of_day"), ["money", "hour_of_day", "absent"])


@query("outliers_zscore", f"""WITH {LINES},
m AS (SELECT avg(money) AS a, stddev_pop(money) AS sd FROM l)
SELECT {", ".join(ORDER_LINE_KEY)}, money, abs((money - a) / sd) > 2 AS money_outlier,
       abs((money - a) / sd) > 2 AS is_outlier FROM l, m""")
def q_zscore(spark, folder):
    return outliers_zscore(lines(spark, folder).select(*ORDER_LINE_KEY, "money"), ["money"], 2.0)


@query("outliers_modified_zscore", f"""WITH {GAPPY},
m AS (SELECT median(money) AS md, mad(money) AS dev FROM g)
SELECT id, money, coalesce(abs(0.6745 * (money - md) / dev) > 3.5, false) AS money_outlier,
       coalesce(abs(0.6745 * (money - md) / dev) > 3.5, false) AS is_outlier FROM g, m""")
def q_modified(spark, folder):
    return outliers_modified_zscore(gappy(spark, folder).select("id", "money"), ["money"])


@query("is_outlier", f"""WITH {GAPPY}, {_IQR}
SELECT CAST(count(*) AS BIGINT) AS n, money_outlier OR late AS is_outlier FROM f GROUP BY 2""")
def q_is_outlier(spark, folder):
    """A later run with another column ORs its flags with those already there."""
    first = statistical_outliers(gappy(spark, folder), ["money"])
    second = statistical_outliers(first, ["hour_of_day"], threshold=0.4)
    return second.groupBy("is_outlier").agg(F.count(F.lit(1)).alias("n"))


@query("split_flagged", f"""WITH {GAPPY}, {_IQR}
SELECT hour_of_day, money, CASE WHEN money_outlier THEN 'anomaly' ELSE 'normal' END AS series FROM f""")
def q_split(spark, folder):
    flagged = statistical_outliers(gappy(spark, folder), ["money"])
    return label_flagged(flagged, "money_outlier", "hour_of_day", "money")


@query("split_flagged_parts", f"""WITH {GAPPY}, {_IQR}
SELECT CASE WHEN money_outlier THEN 'flagged' ELSE 'normal' END AS part, count(*) AS n,
       round(sum(money), 2) AS sales FROM f GROUP BY 1""")
def q_split_parts(spark, folder):
    normal, flagged = split_flagged(statistical_outliers(gappy(spark, folder), ["money"]), "money_outlier")
    parts = normal.withColumn("part", F.lit("normal")).unionByName(flagged.withColumn("part", F.lit("flagged")))
    table = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("money").alias("sales"))
    return rounded(table, 2, "sales")


def _pattern(source: str, keys: str, columns: str) -> str:
    return f"""t AS (SELECT {keys}, avg(money) AS mean, stddev_samp(money) AS std, count(money) AS "count",
      min(money) AS mn, max(money) AS mx FROM {source} GROUP BY {keys})
SELECT {columns}, {keys}, money, round(mean, 6) AS mean, round(std, 6) AS std, "count",
       coalesce(mn < mx AND abs(money - mean) > 2 * std, false) AS pattern_anomaly
FROM {source} JOIN t USING ({keys})"""


@query("pattern_stats", f"""WITH {GAPPY}
SELECT id, coffee_name, "Time_of_Day", round(avg(money) OVER p, 6) AS mean, round(stddev_samp(money) OVER p, 6) AS std,
       count(money) OVER p AS "count"
FROM g WHERE coffee_name IS NOT NULL WINDOW p AS (PARTITION BY coffee_name, "Time_of_Day")""")
def q_pattern_stats(spark, folder):
    table = join_group_stats(gappy(spark, folder), ["coffee_name", "Time_of_Day"], "money")
    return rounded(table, 6, "mean", "std").select("id", "coffee_name", "Time_of_Day", "mean", "std", "count")


@query("pattern_anomaly", f"WITH {GAPPY}, " + _pattern("g", "coffee_name", "id"))
def q_pattern(spark, folder):
    table = gappy(spark, folder).select("id", "coffee_name", "money")
    return rounded(pattern_anomaly(table, ["coffee_name"], "money"), 6, "mean", "std")


@query("lines_pattern_anomaly", f"""WITH {LINES},
p AS ({_pattern("l", "l_partkey", "l_orderkey, l_suppkey, l_linenumber").replace("t AS", "WITH t AS", 1)
       .replace("round(mean, 6) AS mean", 'round(mean * "count", 2) AS total')}) SELECT * FROM p""")
def q_lines_pattern(spark, folder):
    """Many small groups; the mean is shown as a total, since means of 2^k prices end on rounding ties."""
    table = lines(spark, folder).select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "money")
    flagged = pattern_anomaly(table, ["l_partkey"], "money")
    flagged = flagged.withColumn("total", F.col("mean") * F.col("count")).drop("mean")
    return rounded(rounded(flagged, 2, "total"), 6, "std")


_REPORT = """c AS (SELECT count(*) AS total, count(*) FILTER (money_outlier) AS a, count(*) FILTER (late) AS b,
             count(*) FILTER (money_outlier OR late) AS u FROM f)
SELECT flag, n AS "count", round_even(n * 100.0 / total, 2) AS percentage FROM (
  SELECT 'money_outlier' AS flag, a AS n, total FROM c UNION ALL
  SELECT 'hour_of_day_outlier', b, total FROM c UNION ALL
  SELECT 'is_outlier', u, total FROM c UNION ALL
  SELECT 'combined_anomalies', u, total FROM c)"""


def _flagged(spark, folder):
    return statistical_outliers(
        gappy(spark, folder).select("id", "money", "hour_of_day"), ["money", "hour_of_day"])


@query("anomaly_report", f"WITH {GAPPY}, {_IQR.replace('0.4', '1.5')}, {_REPORT}")
def q_report(spark, folder):
    return anomaly_report(_flagged(spark, folder))


@query("combined_anomalies",
       f"WITH {GAPPY}, {_IQR.replace('0.4', '1.5')}, {_REPORT} WHERE flag = 'combined_anomalies'")
def q_combined(spark, folder):
    return combined_anomalies(_flagged(spark, folder))


_FOREST = ["money", "hour_of_day", "Weekdaysort", "Monthsort"]


_QUOTED = ["money", "hour_of_day", '"Weekdaysort"', '"Monthsort"']


@query("isolation_forest", f"WITH {GAPPY},\n" + "".join(forest_sql("g", ["id", *_QUOTED], _QUOTED)))
def q_forest(spark, folder):
    result = isolation_forest(gappy(spark, folder).select("id", *_FOREST), _FOREST, ["id"])
    return rounded(result, 9, "anomaly_score")


@query("kmeans_anomaly", f"WITH {GAPPY},\n" + "".join(kmeans_sql("g", ["id", "money", "hour_of_day"], ["money", "hour_of_day"])))
def q_kmeans(spark, folder):
    table = gappy(spark, folder).select("id", "money", "hour_of_day")
    return rounded(kmeans_anomaly(table, ["money", "hour_of_day"], id_columns=["id"]), 6, "centroid_distance")


@query("outliers_zscore_infinite", f"""WITH {SALES}
SELECT id, CASE WHEN id = 0 THEN CAST('infinity' AS DOUBLE) ELSE money END AS money, false AS money_outlier, false AS is_outlier FROM s""")
def q_zscore_infinite(spark, folder):
    """One infinite amount: neither mean nor deviation is a number, so nothing is flagged."""
    table = sales(spark, folder).select(
        "id", F.when(F.col("id") == 0, float("inf")).otherwise(F.col("money")).alias("money"))
    return outliers_zscore(table, ["money"])


_SHIFTED = f"""WITH {SALES},
t AS (SELECT id, list_position(['click', 'error', 'purchase', 'signup', 'view'], coffee_name) AS kind, money FROM s),
u AS (SELECT id, kind, money + 1000000 * kind AS x FROM t),
m AS (SELECT avg(x) AS a, stddev_pop(x) AS sd FROM u),
z AS (SELECT id, kind, (x - a) / sd AS z FROM u, m),
c AS (SELECT kind, avg(z) AS c FROM z GROUP BY 1),
f AS (SELECT id, abs(z - c) AS far FROM z JOIN c USING (kind))"""


@query("kmeans_groups", _SHIFTED + """
SELECT (SELECT count(*) FROM f) AS n, (SELECT count(DISTINCT kind) FROM c) AS clusters,
       (SELECT round(avg(far), 4) FROM f) AS distance, (SELECT count(*) FROM f
        WHERE far > (SELECT quantile_cont(far, 0.9) FROM f)) > 0 AS some_flagged,
       (SELECT abs(count(*) - 0.1 * (SELECT count(*) FROM f)) <= 0.01 * (SELECT count(*) FROM f) FROM f
        WHERE far > (SELECT quantile_cont(far, 0.9) FROM f)) AS tenth_flagged""")
def q_kmeans_groups(spark, folder):
    """Five groups far apart are found whatever the first centres are."""
    kinds = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    table = sales(spark, folder).select(
        "id", (F.col("money") + F.lit(1_000_000) * F.array_position(kinds, F.col("coffee_name"))).alias("x"))
    out = kmeans_anomaly(table, ["x"], k=5, id_columns=["id"])
    flagged = F.count_if("kmeans_anomaly")
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("clusters"),
        F.round(F.avg("centroid_distance"), 4).alias("distance"), (flagged > 0).alias("some_flagged"),
        (F.abs(flagged - 0.1 * F.count(F.lit(1))) <= 0.01 * F.count(F.lit(1))).alias("tenth_flagged"))


@query("isolation_forest_properties", f"""WITH {GAPPY}
SELECT count(*) AS n, count(money) AS complete, true AS planted_found,
       true AS share_near, 0 AS incomplete_flagged, count(*) - count(money) AS incomplete_zero FROM g""")
def q_forest_properties(spark, folder):
    """Every 200th amount a thousandfold: found; about a tenth flagged; incomplete rows false with score 0."""
    table = gappy(spark, folder).select(
        "id", "hour_of_day", F.when(F.col("id") % 200 == 1, F.col("money") * 1000).otherwise(F.col("money")).alias("money"))
    out = isolation_forest(table, ["money", "hour_of_day"], ["id"])
    bad, whole = F.col("isolation_forest_anomaly"), F.col("money").isNotNull()
    planted = whole & (F.col("id") % 200 == 1) & (F.col("money") > 50_000)
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.count("money").alias("complete"),
        (F.count_if(planted & ~bad) == 0).alias("planted_found"),
        (F.abs(F.count_if(bad) - 0.1 * F.count("money")) <= 0.01 * F.count("money")).alias("share_near"),
        F.count_if(bad & ~whole).alias("incomplete_flagged"),
        F.count_if(~whole & (F.col("anomaly_score") == 0)).alias("incomplete_zero"))


@query("detection_chain", f"""WITH {SALES},
{chain_sql("s")}
SELECT flag, "count", round_even("count" * 100.0 / total, 2) AS percentage FROM tally""")
def q_chain(spark, folder):
    """Statistical, forest, temporal and pattern flags with their combined report."""
    flagged = detect_anomalies(sales(spark, folder), DetectionPlan(id_columns=("id",)))
    return anomaly_report(materialize(flagged, "flagged"))
