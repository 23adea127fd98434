import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from helpers import frame
from tillwatch.operators.quantiles import (
    column_quantiles, exact_quantiles, grouped_quantile, median_abs_dev, quantile_bounds)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def skewed(n: int, seed: int = 1) -> np.ndarray:
    """A third of all rows share one value; the rest has a long tail."""
    rng = np.random.default_rng(seed)
    values = np.exp(rng.normal(3, 2, n)).round(2)
    values[: n // 3] = 38.7
    return values


def check(found, values, probs=PROBS):
    theirs = np.quantile(values, probs)
    assert all(abs(a - b) <= 1e-9 * max(1, abs(b)) for a, b in zip(found, theirs)), (found, theirs)


@pytest.mark.parametrize("direct,accuracy", [(100_000, 10_000), (50, 100), (5, 20), (1, 1000)])
def test_brackets_equal_numpy(spark, direct, accuracy):
    values = skewed(3000)
    df = spark.createDataFrame(pd.DataFrame({"v": values, "w": -values ** 2})).repartition(5)
    found = exact_quantiles(df, ["v", "w"], PROBS, direct_rows=direct, accuracy=accuracy)
    check(found["v"], values)
    check(found["w"], -values ** 2)


def test_partition_count_does_not_matter(spark):
    values = skewed(2000, 7)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    results = {tuple(exact_quantiles(df.repartition(n), ["v"], PROBS, 20, 100)["v"]) for n in (1, 3, 16)}
    assert len(results) == 1


def test_edge_tables(spark):
    none = frame(spark, {"v": [None, None]}, "v double")
    assert exact_quantiles(none, ["v"], [0.5])["v"] == [None]
    one = frame(spark, {"v": [3.5, None]}, "v double")
    assert exact_quantiles(one, ["v"], [0.0, 0.3, 1.0])["v"] == [3.5] * 3
    nan = frame(spark, {"v": [1.0, 2.0, float("nan")]}, "v double")
    assert exact_quantiles(nan, ["v"], [0.5])["v"] == [1.5]
    ends = frame(spark, {"v": [1.0, 2.0, float("inf"), float("-inf")]}, "v double")
    assert exact_quantiles(ends, ["v"], [0.5])["v"] == [1.5]
    same = frame(spark, {"v": [4.0] * 50}, "v double")
    assert exact_quantiles(same, ["v"], [0.25, 0.75], direct_rows=2)["v"] == [4.0, 4.0]
    whole = frame(spark, {"v": [1, 2, 3, 10]}, "v int")
    assert exact_quantiles(whole, ["v"], [0.5])["v"] == [2.5]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1, max_size=60))
def test_any_list(spark, values):
    df = frame(spark, {"v": values}, "v double")
    check(exact_quantiles(df, ["v"], [0.25, 0.5], direct_rows=3, accuracy=50)["v"], values, [0.25, 0.5])


def test_methods_and_tables(spark):
    values = skewed(500)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    check(column_quantiles(df, ["v"], [0.25, 0.75], "builtin")["v"], values, [0.25, 0.75])
    assert len(column_quantiles(df, ["v"], [0.25, 0.75], "approx")["v"]) == 2
    with pytest.raises(ValueError):
        column_quantiles(df, ["v"], [0.5], "magic")
    row = quantile_bounds(df, ["v"], 1.5).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert abs(row["upper"] - (q3 + 1.5 * (q3 - q1))) < 1e-9
    mad = median_abs_dev(df, ["v"]).first()
    med = np.median(values)
    assert abs(mad["mad"] - np.median(abs(values - med))) < 1e-9


@pytest.mark.parametrize("direct", [100_000, 200, 10])
def test_grouped_quantile_with_a_hot_group(spark, direct):
    rng = np.random.default_rng(3)
    n = 6000
    keys = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 30, n).astype(str))
    values = np.where(rng.random(n) < 0.2, 7.0, rng.normal(50, 20, n).round(3))
    table = pd.DataFrame({"k": keys, "v": values})
    df = spark.createDataFrame(table).repartition(6)
    for p in (0.5, 0.9):
        ours = grouped_quantile(df, ["k"], "v", p, "x", direct_rows=direct, accuracy=5000).toPandas().set_index("k")["x"]
        theirs = table.groupby("k")["v"].quantile(p)
        assert len(ours) == len(theirs)
        assert (abs(ours.sort_index() - theirs.sort_index()) < 1e-9).all()


def test_two_heavy_values_settle_at_once(spark, monkeypatch):
    """A rank between two values that most rows share: few passes, the same answer on both ways."""
    from tillwatch.operators import quantiles

    turns = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: (turns.append(1), narrow(*a)))
    df = spark.range(40_000).selectExpr("cast(id % 2 AS int) AS v")
    assert exact_quantiles(df, ["v"], [0.5], direct_rows=100)["v"] == [0.5] and len(turns) <= 3
    groups = spark.range(30_000).selectExpr("id % 3 AS k", "cast(id % 2 AS int) AS v")
    rounds = []
    narrow_groups = quantiles._narrow_groups
    monkeypatch.setattr(quantiles, "_narrow_groups", lambda *a: (rounds.append(1), narrow_groups(*a))[1])
    out = grouped_quantile(groups, ["k"], "v", 0.5, "m", direct_rows=100)
    assert {r["k"]: r["m"] for r in out.collect()} == {0: 0.5, 1: 0.5, 2: 0.5} and len(rounds) <= 3


def test_both_ways_agree_to_the_last_bit(spark):
    df = spark.range(6000).selectExpr("id % 7 AS k", "(id * 7919 % 6007) / 7.0 AS v")
    small = {r["k"]: r["m"] for r in grouped_quantile(df, ["k"], "v", 0.37, "m").collect()}
    large = {r["k"]: r["m"] for r in grouped_quantile(df, ["k"], "v", 0.37, "m", direct_rows=10).collect()}
    assert small == large
