import numpy as np
import pandas as pd
import pytest

from helpers import assert_columns, frame, local, plan
from tillwatch.operators.clusters import first_centers, kmeans_anomaly
from tillwatch.operators.features import standardize
from tillwatch.operators.forest import average_path, grow_tree, isolation_forest, pack_forest, path_lengths
from tillwatch.operators.outliers import (
    outliers_iqr, outliers_modified_zscore, outliers_zscore, statistical_outliers)
from tillwatch.operators.reporting import (
    anomaly_report, combined_anomalies, flagged_rows, select_examples, split_flagged)
from tillwatch.plans.detect import DetectionPlan, detect_anomalies
from tillwatch.sources.sample import synth_sales


def values():
    rng = np.random.default_rng(4)
    v = rng.normal(40, 5, 300).round(2)
    v[::50] += 70
    v[5] = np.nan
    return pd.DataFrame({"id": np.arange(300), "x": v, "y": rng.integers(0, 5, 300)})


@pytest.fixture(scope="module")
def pair(spark):
    from tillwatch.schema import normalize_missing
    theirs = values()
    return normalize_missing(spark.createDataFrame(theirs)).repartition(4).cache(), theirs


def test_iqr_equals_pandas(pair):
    df, theirs = pair
    ours = local(outliers_iqr(df, ["x", "y", "zzz"]), "id")
    for c in ("x", "y"):
        q1, q3 = theirs[c].quantile(0.25), theirs[c].quantile(0.75)
        flags = (theirs[c] < q1 - 1.5 * (q3 - q1)) | (theirs[c] > q3 + 1.5 * (q3 - q1))
        assert list(ours[f"{c}_outlier"]) == list(flags)
    assert list(ours["is_outlier"]) == list(ours["x_outlier"] | ours["y_outlier"])
    assert "zzz_outlier" not in ours


def test_zscore_and_modified(pair):
    df, theirs = pair
    x = theirs["x"]
    ours = local(outliers_zscore(df, ["x"], 3.0), "id")
    assert list(ours["x_outlier"]) == list(((x - x.mean()) / x.std(ddof=0)).abs() > 3)
    ours = local(outliers_modified_zscore(df, ["x"], 3.5), "id")
    mad = (x - x.median()).abs().median()
    assert list(ours["x_outlier"]) == list((0.6745 * (x - x.median()) / mad).abs() > 3.5)
    assert ours["x_outlier"].sum() == 6


def test_constant_columns(spark):
    df = frame(spark, {"id": range(5), "v": [38.7] * 5, "w": [1.0, 1.0, 1.0, 1.0, 5.0], "z": [None] * 5},
               "id int, v double, w double, z double")
    for method in ("iqr", "zscore", "modified_zscore"):
        out = statistical_outliers(df, ["v", "z"], method)
        assert out.filter("is_outlier").count() == 0
    out = local(outliers_modified_zscore(df, ["w"]), "id")
    assert list(out["w_outlier"]) == [False] * 4 + [True]
    with pytest.raises(ValueError):
        statistical_outliers(df, ["v"], "guess")
    with pytest.raises(ValueError):
        statistical_outliers(df, "v")


def test_is_outlier_ignores_itself(spark):
    df = frame(spark, {"v": [1.0, 2.0, 3.0, 100.0]}, "v double")
    once = outliers_iqr(df, ["v"], 0.5)
    again = outliers_iqr(once.drop("v_outlier"), [], 0.5)
    assert once.filter("is_outlier").count() == 1
    assert again.filter("is_outlier").count() == 0


def test_flags_need_no_shuffle(pair, spark):
    table = spark.createDataFrame(values())
    assert "Exchange" not in plan(outliers_iqr(table, ["x"]))


def test_report_and_examples(spark):
    data = {"id": [1, 2, 3, 4, 5, 6, 7, 8], "a_outlier": [True] + [False] * 7,
            "b_anomaly": [True, True, None] + [False] * 5, "anomaly_score": [0.5] * 8}
    df = frame(spark, data, "id int, a_outlier boolean, b_anomaly boolean, anomaly_score double")
    rows = {r["flag"]: (r["count"], r["percentage"]) for r in anomaly_report(df).collect()}
    assert rows == {"a_outlier": (1, 12.5), "b_anomaly": (2, 25.0), "combined_anomalies": (2, 25.0)}
    assert combined_anomalies(df).first()["count"] == 2
    single = df.drop("b_anomaly")
    assert [r["flag"] for r in anomaly_report(single).collect()] == ["a_outlier"]
    assert anomaly_report(df.select("id")).count() == 0
    assert flagged_rows(df).count() == 2
    normal, flagged = split_flagged(df, "b_anomaly")
    assert (normal.count(), flagged.count()) == (6, 2)
    shown = select_examples(df, ["id"], ["id"], 1)
    assert shown.columns == ["id", "a_outlier", "b_anomaly"] and shown.first()["id"] == 1
    assert "TakeOrderedAndProject" in plan(shown)


def test_percentage_rounds_half_even(spark):
    df = frame(spark, {"x_outlier": [True] + [False] * 799}, "x_outlier boolean")
    assert anomaly_report(df).first()["percentage"] == round(1 / 800 * 100, 2) == 0.12


def planted(n=2000, far=20):
    rng = np.random.default_rng(9)
    x, y = rng.normal(0, 1, n), rng.normal(0, 1, n)
    x[:far] += 12
    y[:far] -= 12
    return pd.DataFrame({"id": np.arange(n), "x": x, "y": y})


def test_forest_ranks_planted_points_lowest(spark):
    table = planted()
    df = spark.createDataFrame(table).repartition(6)
    out = local(isolation_forest(df, ["x", "y"], ["id"], contamination=0.05), "id")
    assert set(out.nsmallest(20, "anomaly_score")["id"]) == set(range(20))
    assert out["isolation_forest_anomaly"].sum() == 100
    assert (out["isolation_forest_anomaly"] == (out["anomaly_score"] < 0)).all()
    again = local(isolation_forest(df.repartition(1), ["x", "y"], ["id"], contamination=0.05), "id")
    assert_columns(out["anomaly_score"], again["anomaly_score"], 12)


def test_forest_large_table_path(spark):
    """More rows than the trees draw: every drawn row belongs to one tree."""
    df = spark.createDataFrame(planted(4000, 40)).repartition(6)
    out = local(isolation_forest(df, ["x", "y"], ["id"], trees=50, sample=64, contamination=0.05), "id")
    assert set(out.nsmallest(40, "anomaly_score")["id"]) == set(range(40))


def test_forest_incomplete_rows(spark):
    df = frame(spark, {"id": range(30), "x": [None] + [float(i) for i in range(29)]}, "id int, x double")
    row = isolation_forest(df, ["x"], ["id"]).filter("id = 0").first()
    assert row["isolation_forest_anomaly"] is False and row["anomaly_score"] == 0.0
    none = frame(spark, {"id": [1], "x": [None]}, "id int, x double")
    assert isolation_forest(none, ["x"], ["id"]) is none


def test_tree_walk_equals_node_walk():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(64, 3))
    nodes = [{n[0]: n for n in grow_tree(points, 5, t, 6)} for t in range(4)]
    table = pd.DataFrame([(t, *n) for t, tree in enumerate(nodes) for n in tree.values()],
                         columns=["tree", "node", "feature", "cut", "length"])

    def walk(tree, p):
        at = 1
        while tree[at][1] >= 0:
            at = 2 * at + (p[tree[at][1]] > tree[at][2])
        return tree[at][3]

    wanted = [sum(walk(tree, p) for tree in nodes) for p in points]
    assert path_lengths(pack_forest(table, 6), points, chunk=10).tolist() == wanted
    assert average_path(1) == 0 and average_path(2) == 1 and abs(average_path(256) - 10.2447) < 1e-3
    assert grow_tree(points[::-1], 5, 1, 6) == grow_tree(points, 5, 1, 6)


def test_tree_of_awkward_values():
    """Neighbouring floats and infinities still split into two non-empty sides."""
    column = [1.0, np.nextafter(1.0, 2.0), -np.inf, np.inf, 5.0]
    for seed in range(20):
        nodes = grow_tree(np.array([[v] for v in column]), seed, 0, 8)
        assert sum(n[1] < 0 for n in nodes) == 5


def test_first_centers_are_drawn_by_distance(spark):
    """The race picks a row in proportion to its squared distance, and never a centre again."""
    rows = [("a", 0), ("b", 10), ("c", 30)]
    points = spark.createDataFrame([(x, k) for k, x in rows], "x long, __key string")
    seen = [tuple(c[0] for c in first_centers(points, ["x"], 2, seed)) for seed in range(40)]
    assert all(a < b for a, b in seen)
    firsts_and = {pair: seen.count(pair) for pair in set(seen)}
    assert set(firsts_and) == {(0, 10), (0, 30), (10, 30)}
    # (1/3)(100/1000) + (1/3)(100/500), and so on
    for pair, share in {(0, 10): 0.1, (0, 30): 0.53, (10, 30): 0.37}.items():
        assert abs(firsts_and[pair] / len(seen) - share) < 0.25
    assert first_centers(points, ["x"], 9, 1) == [(0,), (10,), (30,)]


def test_kmeans_of_equal_and_few_rows(spark):
    same = frame(spark, {"id": range(6), "x": [2.0] * 6}, "id int, x double")
    out = kmeans_anomaly(same, ["x"], k=3, id_columns=["id"])
    assert out.filter("cluster = 0 and centroid_distance = 0 and not kmeans_anomaly").count() == 6


def test_kmeans_flags_far_points(spark):
    rng = np.random.default_rng(2)
    table = pd.DataFrame({"id": np.arange(600), "x": np.repeat([0.0, 50.0, 100.0], 200) + rng.normal(0, 1, 600)})
    table["y"] = table["x"] + rng.normal(0, 1, 600)
    table.loc[[0, 200, 400], "y"] += [25, -25, 25]
    df = spark.createDataFrame(table)
    out = local(kmeans_anomaly(df, ["x", "y"], k=3, contamination=0.01), "id")
    assert {0, 200, 400} <= set(out.loc[out["kmeans_anomaly"], "id"])
    assert out["kmeans_anomaly"].sum() == 6 and out["cluster"].nunique() == 3
    gap = frame(spark, {"id": [1], "x": [None], "y": [1.0]}, "id int, x double, y double")
    assert kmeans_anomaly(gap, ["x", "y"]) is gap


def test_detection_chain_on_the_sample(spark):
    out = detect_anomalies(synth_sales(spark, 100), DetectionPlan(trees=20))
    flags = {r["flag"] for r in anomaly_report(out).collect()}
    assert flags == {"money_outlier", "hour_of_day_outlier", "is_outlier", "isolation_forest_anomaly",
                     "temporal_anomaly", "pattern_anomaly", "combined_anomalies"}
    assert out.count() == 100 and out.filter("money_outlier or pattern_anomaly").count() == 0


def test_zscore_of_infinite_and_tiny_values(spark):
    values = [float(i) for i in range(20)] + [float("inf")]
    out = outliers_zscore(frame(spark, {"v": values}, "v double"), ["v"])
    assert out.filter("v_outlier").count() == 0
    tiny = outliers_zscore(frame(spark, {"v": [1e-200, 2e-200, 3e-200]}, "v double"), ["v"])
    assert tiny.filter("v_outlier").count() == 0
    scaled = standardize(frame(spark, {"v": [1e-200, 2e-200, 3e-200]}, "v double"), ["v"]).collect()
    assert all(r["v_scaled"] is not None for r in scaled)
    both = frame(spark, {"v": [float("-inf"), float("-inf"), 1.0, float("inf"), float("inf")]}, "v double")
    assert outliers_iqr(both, ["v"]).filter("v_outlier").count() == 0
