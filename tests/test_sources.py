import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from helpers import frame, local
from tillwatch.schema import NA_TOKENS, SALES_SCHEMA
from tillwatch.session import drop_scratch, materialize, path_exists, scratch_path, scratch_root
from tillwatch.sources.csv import bad_dates, read_csv, read_sales
from tillwatch.sources.sample import synth_sales
from tillwatch.sources.sinks import (
    drop_expired, read_anomaly_reports, retain, write_anomaly_report, write_csv, write_parquet)
from tillwatch.sources.tables import query_options, read_parquet


def test_every_na_token_is_missing(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,v,s\n" + "".join(f"{i},{t},{t}\n" for i, t in enumerate(NA_TOKENS)) + "99,1.5,ok\n")
    out = read_csv(spark, "t.csv", str(tmp_path))
    theirs = pd.read_csv(path)
    assert dict(out.dtypes) == {"id": "bigint", "v": "double", "s": "string"}
    assert out.filter("v is null and s is null").count() == theirs.v.isna().sum() == len(NA_TOKENS)


def test_inferred_types_follow_pandas(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d,e,f,Time,g\n1,1,1.5,x,True,NA,10:30:00,2024-01-01\n2,,2e3,y,False,NA,11:00:00,2024-01-02\n")
    out = read_csv(spark, str(path), parse_dates=["g"])
    theirs = pd.read_csv(path, parse_dates=["g"])
    names = {"int64": "bigint", "float64": "double", "object": "string", "bool": "boolean",
             "datetime64[ns]": "timestamp"}
    assert dict(out.dtypes) == {c: names[str(t)] for c, t in theirs.dtypes.items()}
    assert out.filter("g = timestamp'2024-01-02'").first()["c"] == 2000.0


def test_quoted_cells_and_options(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a;b\n1;"x;""y"\n')
    assert read_csv(spark, str(path), sep=";").first()["b"] == pd.read_csv(path, sep=";").b[0] == 'x;"y'
    assert read_csv(spark, str(path), sep=";", na_values=["1"]).first()["a"] is None


def test_awkward_cells_survive(spark, tmp_path):
    """Quotes, blanks at the ends, line breaks inside cells: both ways, and from a file pandas wrote."""
    texts = ['say "hi"', 'x,"y"', "  pad  ", "two\nlines", "a\\b", ""]
    table = frame(spark, {"id": list(range(6)), "s": texts}, "id long, s string")
    write_csv(table, str(tmp_path / "ours"))
    back = read_csv(spark, str(tmp_path / "ours"), keep_default_na=False)
    assert [r["s"] for r in back.orderBy("id").collect()] == texts
    pd.DataFrame({"id": range(5), "s": texts[:5]}).to_csv(tmp_path / "theirs.csv", index=False)
    back = read_csv(spark, str(tmp_path / "theirs.csv"))
    assert [r["s"] for r in back.orderBy("id").collect()] == texts[:5]


def test_extra_cells_raise(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,s\n1,a\n2,b,lost\n")
    with pytest.raises(Exception, match="more cells"):
        read_csv(spark, str(path), schema=T.StructType.fromDDL("id long, s string")).collect()
    path.write_text("id,s\n1,a\n2\n")  # a short row is filled up
    assert read_csv(spark, str(path)).filter("s is null").count() == 1


def test_missing_file(spark, tmp_path):
    for call in (lambda: read_csv(spark, "no.csv", str(tmp_path)), lambda: read_sales(spark, "no.csv", str(tmp_path)),
                 lambda: read_parquet(spark, str(tmp_path / "no"))):
        with pytest.raises(FileNotFoundError):
            call()


def test_sales_round_trip_and_bad_dates(spark, tmp_path):
    sample = synth_sales(spark, 100).drop("id")
    write_csv(sample, str(tmp_path / "sales"))
    back = read_sales(spark, "sales", str(tmp_path))
    assert back.schema == SALES_SCHEMA
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sample.collect()))
    broken = sample.withColumn("Date", F.when(F.col("Weekdaysort") == 1, "soon").otherwise(F.col("Date").cast("string")))
    write_csv(broken, str(tmp_path / "broken"))
    assert read_sales(spark, "broken", str(tmp_path)).filter("Date is null").count() == 20
    assert bad_dates(spark, "broken", str(tmp_path)).first()[0] == 20
    with pytest.raises(Exception):
        read_sales(spark, "broken", str(tmp_path), on_bad_date="fail").collect()
    with pytest.raises(ValueError):
        read_sales(spark, "broken", str(tmp_path), on_bad_date="guess")
    with pytest.raises(ValueError):
        read_sales(spark, "t.csv", str(_plain(tmp_path)))


def _plain(folder):
    (folder / "t.csv").write_text("a\n1\n")
    return folder


def test_sample_cycles(spark):
    rows = local(synth_sales(spark, 100), "id")
    assert len(rows) == 100
    first = rows.iloc[0]
    assert (first["hour_of_day"], first["cash_type"], first["money"], first["coffee_name"]) == (10, "card", 38.7, "Latte")
    assert (first["Time_of_Day"], first["Weekday"], first["Month_name"], first["Time"]) == ("Morning", "Mon", "Jan", "08:00:00")
    last = rows.iloc[99]
    assert last["Date"] == dt.date(2024, 4, 9) and last["Time"] == "11:00:00" and last["money"] == 42.0
    assert rows["money"].nunique() == 5 and rows["Time_of_Day"].value_counts()["Morning"] == 34


def test_read_parquet_takes_nan_as_missing(spark, tmp_path):
    frame(spark, {"v": [1.0, float("nan")]}, "v double").write.parquet(str(tmp_path / "p"))
    assert read_parquet(spark, str(tmp_path / "p")).filter("v is null").count() == 1


def test_query_options():
    plain = query_options("jdbc:x", "select 1", user="u")
    assert plain == {"url": "jdbc:x", "query": "select 1", "user": "u"}
    ranged = query_options("jdbc:x", "select * from t", "id", 0, 100, 8)
    assert ranged["dbtable"] == "(select * from t) t" and ranged["numPartitions"] == "8" and "query" not in ranged
    with pytest.raises(ValueError):
        query_options("jdbc:x", "select 1", "id")


def test_anomaly_reports_of_several_runs(spark, tmp_path):
    path = str(tmp_path / "reports")
    report = frame(spark, {"flag": ["a", "b"], "count": [1, 2], "percentage": [0.5, 1.0]},
                   "flag string, count long, percentage double")
    write_anomaly_report(report, path, "2024-01-01T09-00-00")
    write_anomaly_report(report, path, "2024-01-02T09-00-00")
    write_anomaly_report(report, path, "2024-01-02T09-00-00")
    assert read_anomaly_reports(spark, path).groupBy("run_ts").count().count() == 2
    assert read_anomaly_reports(spark, path).count() == 4
    name = [n for n in os.listdir(f"{path}/run_ts=2024-01-01T09-00-00") if n.endswith(".json")][0]
    with open(f"{path}/run_ts=2024-01-01T09-00-00/{name}") as handle:
        assert json.loads(handle.readline()) == {"flag": "a", "count": 1, "percentage": 0.5}


def test_retention(spark, tmp_path):
    as_of = dt.date(2024, 3, 1)
    days = [as_of - dt.timedelta(days=n) for n in (0, 29, 30, 31, 400)]
    df = frame(spark, {"run_date": days, "report": list("abcde")}, "run_date date, report string")
    assert sorted(r["report"] for r in retain(df, as_of, 30).collect()) == ["a", "b", "c"]
    path = str(tmp_path / "runs")
    write_parquet(df, path, ["run_date"])
    assert len(drop_expired(spark, path, "2024-03-01", 30)) == 2
    assert sorted(r["report"] for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    again = frame(spark, {"run_date": [as_of], "report": ["z"]}, "run_date date, report string")
    write_parquet(again, path, ["run_date"])  # replaces only its own day
    assert sorted(r["report"] for r in spark.read.parquet(path).collect()) == ["b", "c", "z"]
    assert drop_expired(spark, str(tmp_path / "none"), as_of) == []


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark).startswith(configured.rstrip("/"))
    path = scratch_path(spark, "x")
    table = materialize(spark.range(3), "kept")
    assert table.count() == 3 and not path_exists(spark, path)
    assert "Range" not in table._jdf.queryExecution().toString()
    assert drop_scratch(spark) >= 1 and drop_scratch(spark) == 0
