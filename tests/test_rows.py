import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_columns, frame, local
from tillwatch.functions.bins import SALES_LABELS
from tillwatch.operators.clean import (
    clean, drop_duplicates, drop_missing, fill_median, fill_mode, mode_value, remove_outliers_iqr)
from tillwatch.operators.features import bin_column, calendar_columns, sales_category, standardize
from tillwatch.operators.filters import filter_all, filter_eq, filter_in, filter_range
from tillwatch.plans.transform import transform_sales
from tillwatch.schema import normalize_missing

NAN = float("nan")


def test_nan_becomes_null(spark):
    df = frame(spark, {"id": [1, 2, 3], "v": [NAN, None, 1.0], "s": ["NaN", None, "x"]}, "id long, v double, s string")
    out = normalize_missing(df)
    assert out.filter("v is null").count() == 2
    assert out.filter("s = 'NaN'").count() == 1
    ints = frame(spark, {"id": [1]}, "id long")
    assert normalize_missing(ints) is ints


def test_sales_category_edges(spark):
    money = [-1.0, 0.0, 30.0, 30.01, 40.0, 50.0, 50.01, math.inf, NAN, None]
    df = frame(spark, {"id": list(range(10)), "money": money}, "id int, money double")
    out = local(sales_category(df), "id")
    expected = [None, None, "Baixa", "Média", "Média", "Alta", "Muito Alta", "Muito Alta", None, None]
    assert_columns(out["sales_category"], expected)
    theirs = pd.cut(pd.Series(money), [0, 30, 40, 50, math.inf], labels=SALES_LABELS)
    assert_columns(out["sales_category"], theirs.astype(object))
    assert_columns(out["sales_category_ord"], [None if e is None else SALES_LABELS.index(e) for e in expected])


def test_bin_column_checks_edges(spark):
    df = frame(spark, {"v": [1.0]}, "v double")
    with pytest.raises(ValueError):
        bin_column(df, "v", [0, 1], ["a", "b"], "b")
    with pytest.raises(ValueError):
        bin_column(df, "v", [0, 1, 1], ["a", "b"], "b")


def test_calendar_columns_match_pandas(spark):
    days = pd.date_range("2023-12-25", periods=20)
    df = frame(spark, {"id": range(20), "Date": [d.date() for d in days]}, "id int, Date date")
    out = local(calendar_columns(df), "id")
    assert_columns(out["year"], days.year)
    assert_columns(out["month"], days.month)
    assert_columns(out["day_of_week"], days.day_name())
    assert_columns(out["quarter"], days.quarter)
    text = frame(spark, {"Date": ["2024-02-29"]}, "Date string")
    assert calendar_columns(text).first()["day_of_week"] == "Thursday"
    absent = frame(spark, {"v": [1]}, "v int")
    assert calendar_columns(absent) is absent


def test_filters(spark):
    data = {"id": [1, 2, 3, 4, 5], "k": ["a", "b", None, "a", "c"], "v": [1.0, 2.0, 3.0, None, 5.0]}
    df = frame(spark, data, "id int, k string, v double")
    ids = lambda out: sorted(r["id"] for r in out.collect())
    theirs = pd.DataFrame(data)
    assert ids(filter_range(df, "v", 2, 5)) == [2, 3, 5]
    assert ids(filter_in(df, "k", ["a", None])) == sorted(theirs[theirs.k.isin(["a", None])].id) == [1, 3, 4]
    assert ids(filter_in(df, "k", [])) == []
    assert ids(filter_in(df, "k", [None])) == [3]
    assert ids(filter_eq(df, "k", None)) == list(theirs[theirs.k == None].id) == []  # noqa: E711
    assert ids(filter_all(df, {"k": ["a", "b"], "v": (1, 2), "zzz": 3})) == [1, 2]
    assert ids(filter_all(df, {})) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        filter_all(df, {"v": (1, 2, 3)})


def test_duplicates_and_missing(spark):
    data = {"k": ["a", "a", None, None, "b"], "v": [1.0, 1.0, None, NAN, 2.0]}
    df = normalize_missing(frame(spark, data, "k string, v double"))
    assert drop_duplicates(df).count() == len(pd.DataFrame(data).drop_duplicates()) == 3
    assert drop_missing(df).count() == 3
    assert clean(df).count() == 2
    assert clean(df, handle_missing=None, remove_duplicates=False).count() == 5
    with pytest.raises(ValueError):
        clean(df, handle_missing="guess")


def test_fill_matches_pandas(spark):
    data = {
        "id": list(range(6)),
        "v": [1.0, None, 4.0, 2.0, None, 9.0],
        "n": [1, 2, None, 4, None, 7],
        "s": ["b", "a", "b", "a", None, None],
        "e": [None] * 6,
        "z": [None] * 6,
    }
    df = frame(spark, data, "id long, v double, n long, s string, e string, z double")
    out = local(clean(df, handle_missing="fill"), "id")
    theirs = pd.DataFrame(data)
    assert_columns(out["v"], theirs.v.fillna(theirs.v.median()))
    assert_columns(out["n"], theirs.n.astype("float64").fillna(theirs.n.astype("float64").median()))
    assert_columns(out["s"], theirs.s.fillna(theirs.s.mode()[0]))
    assert set(out["e"]) == {"Unknown"}
    assert out["z"].isna().all()


def test_mode_takes_smallest_tie(spark):
    df = frame(spark, {"s": ["b", "a", "b", "a", "c", None]}, "s string")
    assert mode_value(df, "s") == pd.Series(["b", "a", "b", "a", "c"]).mode()[0] == "a"
    days = frame(spark, {"d": ["2024-01-02", "2024-01-01", None]}, "d string").select(F.to_date("d").alias("d"))
    assert fill_mode(days).filter("d = date'2024-01-01'").count() == 2


def test_fill_median_leaves_complete_tables_alone(spark):
    df = frame(spark, {"v": [1.0, 2.0]}, "v double")
    assert fill_median(df) is df


def test_standardize(spark):
    data = {"id": [0, 1, 2, 3], "x": [1.0, 2.0, 6.0, 100.0], "y": [5.0, 5.0, 5.0, None]}
    out = local(standardize(frame(spark, data, "id int, x double, y double"), ["x", "y"]), "id")
    x = pd.Series([1.0, 2.0, 6.0])
    assert_columns(out["x_scaled"], list((x - x.mean()) / x.std(ddof=0)) + [None])
    assert_columns(out["y_scaled"], [0.0, 0.0, 0.0, None])


def test_remove_outliers_iqr_bounds(spark):
    values = [float(v) for v in range(20)] + [500.0, -300.0, None]
    df = frame(spark, {"money": values}, "money double")
    s = pd.Series(values, dtype="float64")
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    theirs = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    for method in ("exact", "builtin"):
        assert_columns(sorted(r[0] for r in remove_outliers_iqr(df, method=method).collect()), sorted(theirs))
    empty = frame(spark, {"money": [None, None]}, "money double")
    assert remove_outliers_iqr(empty).count() == 0


def test_transform_order(spark):
    """Category before the cut, quartiles of the cleaned rows."""
    money = [10.0 + i / 10 for i in range(40)] + [900.0, 900.0, None]
    data = {"id": list(range(41)) + [40, 42], "money": money[:41] + [900.0, None]}
    out = transform_sales(frame(spark, data, "id int, money double"))
    assert out.count() == 40
    assert "sales_category" in out.columns and "year" not in out.columns
    assert transform_sales(frame(spark, data, "id int, money double"), trim=False).count() == 41
