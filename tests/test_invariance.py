"""Results do not depend on how the rows are partitioned, with a third of them under one key and on one day."""

import numpy as np
import pandas as pd
import pytest

from tillwatch.operators.aggregate import aggregate
from tillwatch.operators.clean import clean
from tillwatch.operators.clusters import kmeans_anomaly
from tillwatch.operators.forest import isolation_forest
from tillwatch.operators.ordered import interpolate, temporal_anomaly
from tillwatch.operators.outliers import outliers_modified_zscore, pattern_anomaly
from tillwatch.operators.tables import pivot_sum
from tillwatch.plans.transform import transform_sales
from tillwatch.schema import normalize_missing


def hot_table(n=1500) -> pd.DataFrame:
    rng = np.random.default_rng(8)
    hot = rng.random(n) < 0.34
    money = rng.gamma(3, 14, n).round(2)
    money[rng.random(n) < 0.08] = np.nan
    table = pd.DataFrame({
        "id": np.arange(n), "coffee_name": np.where(hot, "Latte", rng.choice(list("abcdef"), n)),
        "day": np.where(hot, 3, rng.integers(0, 30, n)), "money": money, "p": rng.choice(["x", "y"], n)})
    copies = table.sample(n // 3, random_state=1)
    one = pd.concat([table.iloc[[0]]] * (n // 3))  # a third of the rows are copies of one row
    return pd.concat([table, copies, one])


CASES = {
    "clean": lambda df: clean(df),
    "fill": lambda df: clean(df, handle_missing="fill"),
    "transform": lambda df: transform_sales(df),
    "temporal": lambda df: temporal_anomaly(df.dropDuplicates(), "day", "money", ["id"]),
    "interpolate": lambda df: interpolate(df.dropDuplicates(), ["money"], ["day", "id"]),
    "pattern": lambda df: pattern_anomaly(df, ["coffee_name"], "money"),
    "modified": lambda df: outliers_modified_zscore(df, ["money"]),
    "aggregate": lambda df: aggregate(df, ["coffee_name", "p"], {"money": ["sum", "mean", "median", "std", "nunique"]}),
    "pivot": lambda df: pivot_sum(df, "coffee_name", "p", "money"),
    "kmeans": lambda df: kmeans_anomaly(df.dropDuplicates(), ["money", "day"], id_columns=["id"]),
    "forest": lambda df: isolation_forest(df.dropDuplicates(), ["money", "day"], ["id"], trees=20),
}


def rows(df) -> list:
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", CASES)
def test_partitioning_does_not_matter(spark, name):
    table = normalize_missing(spark.createDataFrame(hot_table()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for pieces, shuffle in ((1, "1"), (7, "8"), (23, "31")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            found.append(rows(CASES[name](table.repartition(pieces))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and found[0]


def test_copies_are_collapsed_before_the_shuffle(spark):
    table = spark.createDataFrame(hot_table()).repartition(4)
    plan = clean(table, handle_missing=None)._jdf.queryExecution().executedPlan().toString()
    first, exchange = plan.rindex("HashAggregate"), plan.index("Exchange hashpartitioning")
    assert exchange < first  # printed top-down: an aggregate below the exchange
