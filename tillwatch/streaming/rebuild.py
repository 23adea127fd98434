"""Daily totals that stay right when rows come late or files come again.

Every run reads the files that are new.  Rows that an earlier file brought already are
dropped by a bounded state; what is left is appended to a table of rows by day, and only
the days it touches are added up again from that table.  Totals of those days replace the
old ones, all others stay untouched, so a row may be any time late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import q, require_columns
from ..session import path_exists


@dataclass(frozen=True)
class Store:
    """``rows`` by day and batch, ``daily`` totals by day, and the stream's checkpoint."""

    path: str

    @property
    def rows(self) -> str:
        return f"{self.path.rstrip('/')}/rows"

    @property
    def daily(self) -> str:
        return f"{self.path.rstrip('/')}/daily"

    @property
    def checkpoint(self) -> str:
        return f"{self.path.rstrip('/')}/checkpoint"


def run_rebuilding(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    store: str,
    key: list[str],
    transform=lambda df: df,
    time_column: str = "ts",
    product: str = "coffee_name",
    value: str = "money",
    remember: str = "7 days",
    files: str | None = None,
    max_files: int | None = None,
) -> dict[str, int]:
    """Take in the files that came since the last run and rebuild the days they touch.

    ``key`` names the columns that identify a row; where one of them is missing, the whole
    row does.  A row that comes again within
    ``remember`` of its first arrival is dropped before it is stored: the state holds the
    keys of that time only, by arrival and not by the rows' own dates, so no row is ever
    too late for it.  A copy that comes still later is stored, and left out when its day
    is added up; of rows with one key the first batch's counts, in it the smallest.

    A batch is repeated under its own number after a failure, and both its rows and the
    totals of its days are replaced as a whole, so nothing is counted twice.  Rows without
    a time are stored and in no total.  Returns the rows read, the rows stored, the days
    rebuilt (each batch counts its own) and the keys in the state.
    """
    place = Store(store)
    reader = spark.readStream.schema(schema).format("parquet")
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    sales = transform(reader.load(source))
    require_columns(sales, [*key, time_column, product, value])
    seen = {"stored": 0, "days": 0}

    def take_in(batch: DataFrame, number: int) -> None:
        day = F.to_date(F.col(q(time_column)))
        dated = batch.drop("__arrived", "__row").withColumns({"day": day, "batch": F.lit(number).cast("long")})
        # AQE splits a day that holds much of the batch over several tasks
        (dated.hint("rebalance", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(place.rows))
        stored = read_rows(spark, place, dated.schema).filter(F.col("batch") == number)
        touched = stored.groupBy("day").count().collect()  # one row for each day of the batch
        days = [r["day"] for r in touched if r["day"] is not None]
        seen["stored"] += sum(r["count"] for r in touched)
        seen["days"] += len(days)
        if days:
            rows = read_rows(spark, place, dated.schema).filter(F.col("day").isin(days))
            kept = one_of_each(rows.withColumn("__row", _whole_row(sales, key)), [*key, "__row"], product, value)
            (add_up(kept, product, value).hint("rebalance", F.col("day")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(place.daily))

    run = (
        sales.withColumns({"__arrived": F.current_timestamp(), "__row": _whole_row(sales, key)}).withWatermark("__arrived", remember)
        .dropDuplicatesWithinWatermark([*key, "__row"])
        .writeStream.foreachBatch(take_in).option("checkpointLocation", place.checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    progress = run.recentProgress
    states = [s["numRowsTotal"] for p in progress for s in p["stateOperators"]]
    return {"rows": sum(p["numInputRows"] for p in progress), **seen, "remembered": states[-1] if states else 0}


def _whole_row(sales: DataFrame, key: list[str]) -> Column:
    """What tells rows without a complete key apart; null for all others."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(q(k)).isNull()
    return F.when(missing, F.md5(F.to_json(F.struct(*[F.col(q(c)) for c in sales.columns])).cast("binary")))


def read_rows(spark: SparkSession, store: Store, schema: T.StructType) -> DataFrame:
    """All stored rows with their ``day`` and ``batch``."""
    return spark.read.schema(schema).parquet(store.rows)


def one_of_each(rows: DataFrame, key: list[str], product: str, value: str) -> DataFrame:
    """(day, product, value) of one row for each key of a day: the first batch's, then the smallest."""
    names = [q(k) for k in key]
    first = F.min(F.struct("batch", F.col(q(value)).alias("value"), F.col(q(product)).alias("product"))).alias("__first")
    picked = rows.groupBy("day", *[F.col(n).alias(f"__key{i}") for i, n in enumerate(names)]).agg(first)
    return picked.select("day", F.col("__first.product").alias(product), F.col("__first.value").alias(value))


def add_up(rows: DataFrame, product: str, value: str) -> DataFrame:
    return rows.groupBy("day", F.col(q(product))).agg(
        F.sum(F.col(q(value))).alias("sales"), F.count(F.col(q(value))).alias("transactions"))


def read_rebuilt(spark: SparkSession, store: str, product: str = "coffee_name") -> DataFrame:
    """``day, product, sales, transactions`` of every day rebuilt so far; no row before the first run."""
    schema = T.StructType([
        T.StructField(product, T.StringType()), T.StructField("sales", T.DoubleType()),
        T.StructField("transactions", T.LongType()), T.StructField("day", T.DateType())])
    if not path_exists(spark, Store(store).daily):
        return spark.createDataFrame([], schema).select("day", product, "sales", "transactions")
    return spark.read.schema(schema).parquet(Store(store).daily).select("day", product, "sales", "transactions")
