import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402
from helpers import assert_columns, frame, local, plan
from tillwatch.catalog import ORACLE, QUERIES
from tillwatch.functions.bins import SALES_LABELS
from tillwatch.operators.aggregate import (
    Mergeable, aggregate, aggregate_categories, count_distinct_rows, group_stats, join_group_stats)
from tillwatch.operators.features import sales_category
from tillwatch.operators.outliers import pattern_anomaly
from tillwatch.operators.tables import (
    describe, histogram, pivot_sum, product_month, product_month_long, profile, unpivot)
from tillwatch.schema import normalize_missing


def table(n=400, seed=2) -> pd.DataFrame:
    """A hot key, a missing key, an all-missing group and a group of one."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcde"), n)).astype(object)
    keys[:9] = None
    value = rng.normal(40, 9, n).round(2)
    value[rng.random(n) < 0.1] = np.nan
    value[keys == "e"] = np.nan
    keys[20], value[20] = "one", 5.0
    return pd.DataFrame({"id": np.arange(n), "k": keys, "p": rng.choice(["x", "y"], n), "v": value,
                         "n": rng.integers(0, 5, n)})


@pytest.fixture(scope="module")
def pair(spark):
    theirs = table()
    return normalize_missing(spark.createDataFrame(theirs)).repartition(5).cache(), theirs


NAMES = ["sum", "mean", "median", "min", "max", "count", "size", "std", "var", "sem", "nunique", "prod", "skew"]


def test_function_table_equals_pandas(pair):
    df, theirs = pair
    ours = local(aggregate(df, ["k"], {"v": NAMES + ["quantile"], "n": ["sum", "nunique", "mean"]}), "k")
    group = theirs.groupby("k")
    wanted = group.agg({"v": NAMES, "n": ["sum", "nunique", "mean"]})
    wanted.columns = [f"{a}_{b}" for a, b in wanted.columns]
    wanted["v_quantile"] = group["v"].quantile()
    assert list(ours["k"]) == list(wanted.index)
    for c in wanted.columns:
        assert_columns(ours[c], wanted[c], 6)
    assert list(ours.columns) == ["k", *[f"v_{f}" for f in NAMES], "v_quantile", "n_sum", "n_nunique", "n_mean"]


def test_first_and_last_skip_missing(spark):
    data = {"id": [1, 2, 3, 4], "k": ["a"] * 4, "v": [None, 2.0, 3.0, None]}
    df = frame(spark, data, "id int, k string, v double")
    row = aggregate(df, ["k"], {"v": ["first", "last"]}, order_by=["id"]).first()
    theirs = pd.DataFrame(data).groupby("k")["v"].agg(["first", "last"]).iloc[0]
    assert (row["v_first"], row["v_last"]) == (theirs["first"], theirs["last"]) == (2.0, 3.0)
    with pytest.raises(ValueError):
        aggregate(df, ["k"], {"v": ["first"]})


def test_aggregate_refuses_what_it_cannot_do(pair):
    df, _ = pair
    for keys, functions in (("k", {"v": ["sum"]}), (["k"], {"v": "sum"}), (["k"], {"v": ["nope"]}),
                            (["zzz"], {"v": ["sum"]}), ([], {"v": ["sum"]})):
        with pytest.raises(ValueError):
            aggregate(df, keys, functions)


def test_callables(pair):
    df, theirs = pair
    group = theirs.groupby("k")["v"]
    moments = Mergeable(
        "rms",
        partial=lambda s: (float((s ** 2).sum()), len(s)),
        merge=lambda states: (sum(a for a, _ in states), sum(b for _, b in states)),
        finish=lambda state: (state[0] / state[1]) ** 0.5 if state[1] else None,
    )

    def spread(x):
        return F.max(x) - F.min(x)

    ours = local(aggregate(df, ["k"], {"v": [moments, spread, "count"]}), "k")
    assert_columns(ours["v_rms"], group.agg(lambda s: (s ** 2).mean() ** 0.5))
    assert_columns(ours["v_spread"], group.max() - group.min())


def test_mergeable_folds_a_hot_group_in_levels(spark, monkeypatch):
    """Many small tasks and batches, two thirds of the rows in one group, few states folded at a time."""
    monkeypatch.setattr("tillwatch.operators.aggregate.FAN_IN", 4)
    total = Mergeable("total", partial=lambda s: int(s.sum()), merge=sum, finish=lambda state: state, return_type="long")
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'cold', 'hot') AS k", "id AS v").repartition(23)
    out = {r["k"]: r["v_total"] for r in aggregate(df, ["k"], {"v": [total]}).collect()}
    assert out == {"cold": sum(range(0, 3000, 3)), "hot": sum(i for i in range(3000) if i % 3)}


def test_category_grid_keeps_observed_combinations(spark):
    """With two further keys only their observed combinations appear, each with every level."""
    data = {"a": ["x", "y"], "b": ["p", "q"], "money": [10.0, 45.0]}
    df = sales_category(frame(spark, data, "a string, b string, money double"))
    out = aggregate_categories(df, ["sales_category", "a", "b"], {"money": ["count"]}).collect()
    assert len(out) == 2 * len(SALES_LABELS) and {(r["a"], r["b"]) for r in out} == {("x", "p"), ("y", "q")}


def test_long_heat_map_has_no_column_limit(spark):
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        data = {"coffee_name": ["a", "a", "b"], "Date": ["2024-01-03", "2024-02-03", "2024-03-09"], "money": [1.0, 2.0, 4.0]}
        df = frame(spark, data, "coffee_name string, Date string, money double").withColumn("Date", F.to_date("Date"))
        out = {(r[0], r[1]): r[2] for r in product_month_long(df).collect()}
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)
    assert len(out) == 6 and out["a", "2024-02"] == 2.0 and out["b", "2024-01"] == 0.0


def test_categories_are_complete(spark):
    data = {"k": ["a", "a", "b", "b"], "money": [10.0, 20.0, 45.0, None]}
    df = sales_category(frame(spark, data, "k string, money double"))
    theirs = pd.DataFrame(data)
    theirs["sales_category"] = pd.cut(theirs.money, [0, 30, 40, 50, np.inf], labels=SALES_LABELS)
    wanted = theirs.groupby("sales_category", observed=False)["money"].agg(["sum", "count", "mean"]).reset_index()
    ours = aggregate_categories(df, ["sales_category"], {"money": ["sum", "count", "mean"]}).toPandas()
    assert list(ours["sales_category"]) == list(wanted["sales_category"])
    for f in ("sum", "count", "mean"):
        assert_columns(ours[f"money_{f}"], wanted[f])
    both = aggregate_categories(df, ["k", "sales_category"], {"money": ["sum"]}).toPandas()
    wanted = theirs.groupby(["k", "sales_category"], observed=False)["money"].sum().reset_index()
    assert list(both["k"]) == list(wanted["k"]) and list(both["money_sum"]) == list(wanted["money"])
    assert aggregate_categories(df, ["sales_category"], {"money": ["sum"]}, observed=True).count() == 2


def test_join_group_stats_is_a_broadcast_and_drops_null_keys(pair):
    df, theirs = pair
    out = join_group_stats(df, ["k"], "v")
    assert "BroadcastHashJoin" in plan(out)
    stats = theirs.groupby("k")["v"].agg(["mean", "std", "count"]).reset_index()
    wanted = theirs.merge(stats, on=["k"]).sort_values("id")
    ours = local(out, "id")
    assert list(ours["id"]) == list(wanted["id"])
    for c in ("mean", "std", "count"):
        assert_columns(ours[c], wanted[c])


def test_join_group_stats_above_the_broadcast_limit(spark, pair):
    df, theirs = pair
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_group_stats(df, ["k", "p"], "v")
        assert "BroadcastHashJoin" not in plan(out)
        assert out.count() == theirs.k.notna().sum()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pattern_anomaly(pair):
    df, theirs = pair
    ours = local(pattern_anomaly(df, ["k"], "v"), "id")
    stats = theirs.groupby("k")["v"].agg(["mean", "std"]).reset_index()
    wanted = theirs.merge(stats, on="k").sort_values("id")
    flags = (wanted["v"] - wanted["mean"]).abs() > 2 * wanted["std"]
    assert list(ours["pattern_anomaly"]) == list(flags)
    assert "min" not in ours and "count" in ours


def test_pattern_constant_groups_and_name_clash(spark):
    data = {"k": ["a"] * 7 + ["b"] * 3, "v": [38.7] * 7 + [0.1] * 3, "mean": [0.0] * 10, "min": [1.0] * 10}
    out = pattern_anomaly(frame(spark, data, "k string, v double, mean double, min double"), ["k"], "v")
    assert out.filter("pattern_anomaly").count() == 0
    assert {"mean", "mean_group", "std", "min"} <= set(out.columns) and "min_group" not in out.columns
    assert out.first()["mean"] == 0.0


def test_group_stats_of_one(spark):
    row = group_stats(frame(spark, {"k": ["a"], "v": [2.0]}, "k string, v double"), ["k"], "v").first()
    assert row["mean"] == 2.0 and row["std"] is None and row["count"] == 1


@pytest.mark.parametrize("fill", [0, -5])
def test_pivot_equals_pandas(pair, fill):
    df, theirs = pair
    ours = pivot_sum(df, "k", "p", "v", fill_value=fill).toPandas()
    wanted = theirs.pivot_table(index="k", columns="p", values="v", aggfunc="sum", fill_value=fill)
    assert list(ours["k"]) == list(wanted.index) and list(ours.columns[1:]) == list(wanted.columns)
    for c in wanted.columns:
        assert_columns(ours[c], wanted[c])


def test_pivot_refuses_too_many_columns(spark, pair):
    df, _ = pair
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            pivot_sum(df, "p", "k", "v")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_product_month_and_long_form(spark):
    import datetime as dt
    data = {"coffee_name": ["a", "a", "b", None], "money": [1.0, 2.0, 4.0, 8.0],
            "Date": [dt.date(2024, 1, 5), dt.date(2024, 3, 1), dt.date(2024, 3, 9), dt.date(2024, 4, 1)]}
    wide = product_month(frame(spark, data, "coffee_name string, money double, Date date"))
    assert wide.columns == ["coffee_name", "2024-01", "2024-03"]
    assert [tuple(r) for r in wide.collect()] == [("a", 1.0, 2.0), ("b", 0.0, 4.0)]
    assert unpivot(wide, "coffee_name", "month", "sales").count() == 4


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 10.0, None], [38.7] * 4, [0.1 * i for i in range(100)],
                                    [round(0.07 * i % 9.3, 2) for i in range(400)], [round(i / 3, 2) for i in range(301)]])
def test_histogram_equals_numpy(spark, values):
    out = local(histogram(frame(spark, {"money": values}, "money double")), "bin")
    counts, edges = np.histogram([v for v in values if v is not None], bins=30)
    assert len(out) == 30 and out["count"].sum() == counts.sum()
    assert_columns(out["bin_start"], edges[:-1])
    assert_columns(out["bin_end"], edges[1:])
    assert list(out["count"]) == list(counts)


def test_profile_and_describe(pair):
    df, theirs = pair
    out = profile(df).toPandas()
    assert list(out["column"]) == df.columns
    assert list(out["null_count"]) == list(theirs.isnull().sum()) and set(out["row_count"]) == {len(theirs)}
    ours = describe(df).toPandas().set_index("column")
    wanted = theirs.describe()
    for c in ("id", "v", "n"):
        row = ours.loc[c, ["count", "mean", "std", "min", "q25", "median", "q75", "max"]]
        assert_columns(row, wanted[c], 8)


def test_count_distinct(pair):
    df, theirs = pair
    row = count_distinct_rows(df, ["k", "v"]).first()
    assert (row["k"], row["v"]) == (theirs.k.nunique(), theirs.v.nunique())


def test_callable_query_with_a_smallest_value_of_zero(spark, tmp_path):
    """A group that begins at zero and one of zeros alone, as the SQL divides them."""
    rows = [(1, "view", 0.0), (2, "view", 4.0), (3, "click", 2.0), (4, "click", 5.0), (5, "error", 0.0), (6, "signup", -1.0), (8, "signup", 0.0)]
    stamp = F.timestamp_seconds(F.col("event_id") * 3600)
    table = spark.createDataFrame(rows, "event_id long, event_type string, value double")
    table.select("event_id", stamp.cast("timestamp_ntz").alias("ts"), F.lit(2).cast("bigint").alias("user_id"), "event_type", "value",
                 ).coalesce(1).toPandas().to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    line, good = compare.compare(spark, compare.connect(str(tmp_path)), str(tmp_path), "aggregate_callable",
                                 QUERIES["aggregate_callable"], ORACLE["aggregate_callable"])
    assert good, line
    ratios = {r["coffee_name"]: r["money_ratio"] for r in QUERIES["aggregate_callable"](spark, str(tmp_path)).collect()}
    assert ratios["view"] == float("inf") and np.isnan(ratios["error"]) and ratios["click"] == 2.5
