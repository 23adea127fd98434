import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helpers import assert_columns, frame, local, plan
from tillwatch.operators.blocks import Blocks
from tillwatch.operators.ordered import interpolate, rolling_mean, rolling_std, row_index, sort_by_date, temporal_anomaly


def series(n=500, seed=5, hot=0.34):
    """Sales over 40 days, a third of them on one day, with gaps."""
    rng = np.random.default_rng(seed)
    day = np.where(rng.random(n) < hot, 11, rng.integers(0, 40, n))
    value = rng.normal(40, 5, n).round(2)
    value[rng.random(n) < 0.02] += 60
    table = pd.DataFrame({"id": np.arange(n), "day": day, "v": value})
    table.loc[rng.random(n) < 0.1, "v"] = np.nan
    return table


def to_spark(spark, table):
    from tillwatch.schema import normalize_missing
    return normalize_missing(spark.createDataFrame(table)).repartition(4)


@pytest.mark.parametrize("blocks", [None, 1, 7, 60])
@pytest.mark.parametrize("window", [1, 7, 30, 33, 90])
def test_rolling_equals_pandas(spark, blocks, window):
    """Also with blocks shorter than the window."""
    table = series(200)
    ordered = table.sort_values(["day", "id"])
    roll = ordered["v"].rolling(window)
    theirs = ordered.assign(m=roll.mean(), s=roll.std()).sort_values("id")
    df = to_spark(spark, table)
    ours = local(rolling_mean(df, "v", window, ["day", "id"], blocks=blocks), "id")
    assert_columns(ours["rolling_mean"], theirs["m"])
    if window > 1:
        ours = local(rolling_std(df, "v", window, ["day", "id"], blocks=blocks), "id")
        assert_columns(ours["rolling_std"], theirs["s"], 6)
    assert list(ours.columns[:3]) == ["id", "day", "v"]


@pytest.mark.parametrize("blocks", [None, 9])
def test_temporal_equals_pandas_and_the_plain_window(spark, blocks):
    table = series()
    ordered = table.sort_values(["day", "id"])
    roll = ordered["v"].rolling(7)
    flags = ((ordered["v"] - roll.mean()).abs() > 2 * roll.std()).sort_index()
    df = to_spark(spark, table)
    out = temporal_anomaly(df, "day", "v", ["id"], blocks=blocks)
    ours = local(out, "id")
    assert list(ours["temporal_anomaly"]) == list(flags)
    assert flags.sum() > 3
    frame_ = Window.orderBy("day", "id").rowsBetween(-6, 0)
    plain = df.withColumn("f", F.coalesce(
        (F.count("v").over(frame_) == 7)
        & (F.abs(F.col("v") - F.avg("v").over(frame_)) > 2 * F.stddev_samp("v").over(frame_)), F.lit(False)))
    assert list(local(plain, "id")["f"]) == list(ours["temporal_anomaly"])


def test_constant_and_short_frames_never_flag(spark):
    df = frame(spark, {"id": range(10), "v": [38.7] * 10}, "id int, v double")
    assert temporal_anomaly(df, "id", "v", []).filter("temporal_anomaly").count() == 0
    short = frame(spark, {"id": [1, 2], "v": [1.0, 900.0]}, "id int, v double")
    out = temporal_anomaly(short, "id", "v", [])
    assert out.filter("rolling_mean is not null or temporal_anomaly").count() == 0


def test_no_single_task_window(spark):
    df = to_spark(spark, series())
    out = temporal_anomaly(df, "day", "v", ["id"], blocks=4)
    text = plan(out)
    assert "SinglePartition" not in text
    assert "Window" in text


def test_row_index_is_the_global_order(spark):
    table = series(300)
    ours = local(row_index(to_spark(spark, table), ["day", "id"], blocks=13), "id")
    theirs = table.sort_values(["day", "id"]).reset_index(drop=True).reset_index().sort_values("id")["index"]
    assert list(ours["row_index"]) == list(theirs)


def test_blocks_cover_all_rows_and_see_those_before(spark):
    df = to_spark(spark, series(300))
    for halo in (0, 6, 100):
        cut = Blocks(df, ["day", "id"], 50, halo=halo)
        assert [b.start for b in cut.found] == [0, *[b.end for b in cut.found[:-1]]] and cut.found[-1].end == 300
        assert len(cut.found) > 20 and sum(cut.sizes) == 300
        rows = cut.dealt()
        own = rows.filter("not __halo")
        assert own.count() == own.select("id").distinct().count() == 300
        seen = {r["__block"]: r["n"] for r in rows.filter("__halo").groupBy("__block").agg(F.count("*").alias("n")).collect()}
        assert all(seen.get(b.number, 0) >= min(halo, b.start) for b in cut.found)


def wide_exchanges(df) -> list[str]:
    """Shuffles of the final plan that carry the rows' payload."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange" in line]


@pytest.mark.parametrize("window", [7, 200])
def test_one_exchange_and_no_written_table(spark, monkeypatch, window):
    from tillwatch import session
    monkeypatch.setattr(session, "materialize", None)  # nothing is written
    df = to_spark(spark, series()).withColumn("payload", F.lit("x"))
    for out in (rolling_mean(df, "v", window, ["day", "id"], blocks=5), rolling_std(df, "v", window, ["day", "id"], blocks=5),
                temporal_anomaly(df, "day", "v", ["id"], window, blocks=5, sort=False), row_index(df, ["day", "id"], blocks=5),
                interpolate(df, ["v"], ["day", "id"], blocks=5)):
        exchanges = [e for e in wide_exchanges(out) if "REPARTITION_BY_NUM" not in e]  # that is to_spark's own
        assert len(exchanges) == 1 and "hashpartitioning(__block" in exchanges[0], exchanges


def test_long_frames_of_far_and_constant_values(spark):
    """A far value leaves no trace in later frames, a constant frame is exact, gaps and infinities stay where they are."""
    values = [0.1] * 150 + [1e16] + [0.1] * 150 + [None] + [0.1 + i * 1e-3 for i in range(150)] + [float("inf")] + [0.3] * 60
    table = pd.DataFrame({"id": range(len(values)), "v": values})
    df = frame(spark, {"id": range(len(values)), "v": values}, "id int, v double").repartition(3)
    for window in (33, 50):
        ours = local(rolling_mean(df, "v", window, ["id"], blocks=6), "id")["rolling_mean"]
        stds = local(rolling_std(df, "v", window, ["id"], blocks=6), "id")["rolling_std"]
        for i in range(len(values)):
            frame_ = values[max(0, i - window + 1):i + 1]
            if len(frame_) < window or None in frame_:
                assert np.isnan(ours[i])
            elif len(set(frame_)) == 1:
                assert ours[i] == frame_[0] and stds[i] == 0
            elif max(frame_) < 1e10:
                assert abs(ours[i] - np.mean(frame_)) < 1e-14 and abs(stds[i] - np.std(frame_, ddof=1)) < 1e-14
        assert table.shape[0] == len(ours)
    assert temporal_anomaly(df.filter("id < 150"), "id", "v", [], 50).filter("temporal_anomaly").count() == 0


def test_long_windows_cost_little_more(spark):
    """A hundred times the rows in a frame, not a hundred times the work."""
    import time
    df = spark.range(150_000).select("id", ((F.col("id") * 7919) % 10_007).cast("double").alias("v")).cache()
    df.count()

    def seconds(window):
        best = []
        for _ in range(3):
            start = time.perf_counter()
            rolling_std(df, "v", window, ["id"], blocks=8).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    short, long = seconds(7), seconds(1000)
    df.unpersist()
    assert long < 2 * short + 0.5, (short, long)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,3)", "string", "double", "boolean", "binary", "smallint"])
def test_order_keys_of_any_plain_type(spark, kind):
    """Blocks follow Spark's own order, missing keys last."""
    rng = np.random.default_rng(4)
    n = 160
    number = rng.integers(-50, 50, n)
    text = {"date": lambda x: f"20{60 + x // 2:02d}-03-04", "timestamp": lambda x: f"2024-03-31 0{abs(x) % 9}:0{abs(x) % 7}:01.{abs(x):06d}",
            "timestamp_ntz": lambda x: f"2024-03-31 0{abs(x) % 9}:0{abs(x) % 7}:01.{abs(x):06d}", "string": lambda x: f"é'\\{x}\n",
            "boolean": lambda x: str(x > 0).lower(), "binary": lambda x: f"b{x}"}.get(kind, lambda x: f"{x / 4}" if kind == "double" else str(x))
    rows = [(i, None if i % 11 == 0 else text(int(x)), float(i % 13)) for i, x in enumerate(number)]
    df = spark.createDataFrame(rows, "id int, t string, v double").withColumn("k", F.col("t").cast(kind)).drop("t").repartition(5)
    ours = local(row_index(df, ["k", "id"], blocks=12), "id")["row_index"]
    plain = local(df.withColumn("r", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last(), "id")) - 1), "id")["r"]
    assert list(ours) == list(plain)


def test_nested_order_keys_are_refused(spark):
    df = spark.range(3).withColumn("a", F.array("id"))
    with pytest.raises(ValueError):
        row_index(df, ["a"])


def test_empty_table(spark):
    empty = frame(spark, {"id": [1], "v": [1.0]}, "id int, v double").filter("id > 5")
    assert temporal_anomaly(empty, "id", "v", []).count() == 0
    assert interpolate(empty, ["v"], ["id"]).count() == 0


def test_missing_order_keys_sort_last(spark):
    df = frame(spark, {"id": [1, 2, 3], "d": [None, 2, 1]}, "id int, d int")
    assert [r["id"] for r in sort_by_date(df, "d", ["id"]).collect()] == [3, 2, 1]
    assert [r["row_index"] for r in row_index(df, ["d", "id"]).orderBy("id").collect()] == [2, 1, 0]


def test_order_is_required(spark):
    df = frame(spark, {"id": [1], "v": [1.0]}, "id int, v double")
    for call in (lambda: rolling_mean(df, "v", 3, None), lambda: interpolate(df, ["v"]), lambda: row_index(df, [])):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("blocks", [None, 1, 6, 40])
def test_interpolate_equals_pandas(spark, blocks):
    table = series(120)[["id", "v"]]
    table.loc[0:4, "v"] = np.nan
    table.loc[30:75, "v"] = np.nan  # a gap over several blocks
    table.loc[115:, "v"] = np.nan
    table["s"] = "x"
    ours = local(interpolate(to_spark(spark, table), order_by=["id"], blocks=blocks), "id")
    assert_columns(ours["v"], table["v"].interpolate())
    assert list(ours["s"]) == ["x"] * 120


def test_interpolate_types(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    df = frame(spark, {
        "id": [0, 1, 2, 3], "n": [None, 1, None, 2], "d": [day(0), None, day(4), None],
        "t": [dt.datetime(2024, 1, 1), None, dt.datetime(2024, 1, 1, 1), None], "z": [None] * 4,
    }, "id long, n long, d date, t timestamp, z double")
    out = local(interpolate(df, order_by=["id"]), "id")
    assert_columns(out["n"], [None, 1.0, 1.5, 2.0])
    assert list(out["d"]) == [day(0), day(2), day(4), day(4)]
    assert list(out["t"]) == [pd.Timestamp("2024-01-01"), pd.Timestamp("2024-01-01 00:30"),
                              pd.Timestamp("2024-01-01 01:00"), pd.Timestamp("2024-01-01 01:00")]
    assert out["z"].isna().all()
    words = frame(spark, {"k": ["a", None]}, "k string")
    with pytest.raises(ValueError):
        interpolate(words, order_by=["k"])


def test_interpolate_leaves_complete_columns_alone(spark):
    df = frame(spark, {"id": [1, 2, 3], "big": [9007199254740993, 1, 2], "v": [1.0, None, 3.0]}, "id long, big long, v double")
    out = interpolate(df, None, ["id"]).orderBy("id")
    assert dict(out.dtypes)["big"] == "bigint" and out.first()["big"] == 9007199254740993
    assert [r["v"] for r in out.collect()] == [1.0, 2.0, 3.0]


def test_temporal_rows_come_in_date_order(spark):
    df = spark.range(200).selectExpr("id", "(id * 37) % 200 AS day", "cast(id AS double) AS v").repartition(7)
    assert [r["day"] for r in temporal_anomaly(df, "day", "v", ["id"]).collect()] == list(range(200))
