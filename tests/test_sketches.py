import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from helpers import frame
from tillwatch.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, merged_bounds, merged_distinct, merged_quantiles, merged_summary, sketch_days)
from tillwatch.operators.tables import cell, pivot_map, pivot_rows, pivot_sum
from tillwatch.operators.outliers import statistical_outliers
from tillwatch.operators.forest import isolation_forest
from tillwatch.sources.sample import synth_seasonal
from tillwatch.sources.sinks import write_parquet


def sales(n=40_000):
    rng = np.random.default_rng(6)
    day = np.where(rng.random(n) < 0.34, 5, rng.integers(0, 30, n))
    return pd.DataFrame({"day0": day, "money": rng.gamma(2, 20, n).round(2), "p": rng.integers(0, 5000, n)})


def stored(spark, table, path):
    df = spark.createDataFrame(table).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("day0").cast("int")).alias("Date"), "money", "p")
    days = sketch_days(df, "Date", ["money"], ["p"])
    write_parquet(days, path, ["day"])
    return spark.read.schema(days.schema).parquet(path)


def test_any_set_of_days(spark, tmp_path):
    table = sales()
    days = stored(spark, table, str(tmp_path / "d"))
    assert days.count() == 30
    for chosen in (range(30), [5], [1, 2, 3], range(0, 30, 7)):
        part = table[table["day0"].isin(list(chosen))]
        some = days.filter(F.col("day").isin([dt.date(2024, 1, 1 + d) for d in chosen]))
        values = np.sort(part["money"].to_numpy())
        for r in merged_quantiles(some, "money", [0, 0.1, 0.5, 0.9, 1]).collect():
            assert (r["n"], r["min"], r["max"]) == (len(values), values[0], values[-1])
            low, high = np.searchsorted(values, r["value"], "left"), np.searchsorted(values, r["value"], "right")
            slack = RANK_ERROR * len(values) + 1
            assert low - slack <= r["prob"] * len(values) <= high + slack
        exact = part["p"].nunique()
        assert abs(merged_distinct(some, "p").first()["estimate"] - exact) <= DISTINCT_ERROR * exact
        total = merged_summary(some, "money", "p").first()
        assert abs(total["total_sales"] - part["money"].sum()) < 1e-4 and total["total_transactions"] == len(part)
    bounds = merged_bounds(days, "money").first()
    assert bounds["lower"] < bounds["q1"] < bounds["q3"] < bounds["upper"] and bounds["n"] == 40_000


def test_a_rebuilt_day_replaces_its_sketch(spark, tmp_path):
    path = str(tmp_path / "d")
    stored(spark, sales(2000), path)
    again = pd.DataFrame({"day0": [5] * 10, "money": [1.0] * 10, "p": [1] * 10})
    days = stored(spark, again, path)
    assert days.count() == 30
    one = merged_quantiles(days.filter("day = '2024-01-06'"), "money", [0.5]).first()
    assert (one["n"], one["value"]) == (10, 1.0)


def test_sketches_of_gaps(spark):
    df = frame(spark, {"Date": [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 2), None], "v": [1.0, float("nan"), None, 9.0],
                       "k": ["a", None, None, "b"]}, "Date date, v double, k string")
    days = sketch_days(df, "Date", ["v"], ["k"])
    assert {r["day"].day: (r["rows"], r["v_n"]) for r in days.collect()} == {1: (2, 1), 2: (1, 0)}
    assert merged_quantiles(days, "v", [0.5]).first()["value"] == 1.0
    assert merged_quantiles(days.filter("day = '2024-01-02'"), "v", [0.5]).count() == 0
    assert merged_distinct(days, "k").first()["estimate"] == 1
    empty = sketch_days(df.filter("false"), "Date", ["v"], ["k"])
    assert merged_quantiles(empty, "v", [0.5]).count() == 0 and merged_distinct(empty, "k").first()["estimate"] == 0


def test_pivot_map_has_the_cells_of_the_pivot(spark):
    df = frame(spark, {"i": ["a", "a", "b", None, "b", "a"], "c": [1, 2, 1, 1, None, 1], "v": [1.0, 2.0, None, 5.0, 6.0, 0.5]}, "i string, c int, v double")
    made = pivot_map(df, "i", "c", "v")
    assert {r["i"]: r["cells"] for r in made.collect()} == {"a": {1: 1.5, 2: 2.0}, "b": {1: 0.0}}
    wide = {r["i"]: (r["1"], r["2"]) for r in pivot_sum(df, "i", "c", "v").collect()}
    assert {r["i"]: (r["x"], r["y"]) for r in made.select("i", cell("cells", 1).alias("x"), cell("cells", 2).alias("y")).collect()} == wide
    assert sorted(tuple(r) for r in pivot_rows(made, "i").collect()) == [("a", 1, 1.5), ("a", 2, 2.0), ("b", 1, 0.0)]


def test_pivot_map_of_many_labels(spark):
    table = spark.range(60_000).select((F.col("id") % 3).alias("i"), (F.col("id") % 20_000).alias("c"), F.lit(1.0).alias("v"))
    made = pivot_map(table, "i", "c", "v")
    assert [r[0] for r in made.select(F.size("cells")).collect()] == [20_000] * 3


def test_seasonal_sales(spark):
    made = synth_seasonal(spark, 20_000).toPandas()
    day = pd.to_datetime(made["Date"])
    assert (made["Weekday"] == day.dt.strftime("%a")).all() and (made["Month_name"] == day.dt.strftime("%b")).all()
    assert (made["hour_of_day"] == made["Time"].str[:2].astype(int)).all() and set(day.dt.year) == {2024}
    hours = made["hour_of_day"].value_counts()
    assert hours[9] > 2 * hours[14] and hours[17] > 2 * hours[21]  # peak hours
    months = made["Monthsort"].value_counts()
    assert months[12] > 1.2 * months[2]  # a season
    assert 0.007 < made["planted"].mean() < 0.013
    assert made["money"][made["planted"]].min() > made["money"][~made["planted"]].max()
    again = synth_seasonal(spark, 20_000).repartition(3).orderBy("id").toPandas()
    assert again.equals(made.sort_values("id").reset_index(drop=True))


def test_detectors_find_what_is_planted(spark):
    made = synth_seasonal(spark, 6000)
    flagged = statistical_outliers(made, ["money"])
    assert flagged.filter("planted and not is_outlier").count() == 0
    assert flagged.filter("not planted and is_outlier").count() == 0
    scored = isolation_forest(made, ["money", "hour_of_day"], ["id"], contamination=0.02)
    planted = scored.filter("planted").count()
    assert scored.filter("planted and isolation_forest_anomaly").count() >= 0.9 * planted > 40
