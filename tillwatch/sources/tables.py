"""Parquet and database scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schema import normalize_missing
from ..session import path_exists


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; NaN is taken as missing.  Pruning and pushdown are Catalyst's."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.schema(schema) if schema else spark.read
    return normalize_missing(reader.parquet(path))


def query_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    **options,
) -> dict[str, str]:
    """JDBC options of a query: one task by default, ranged tasks with a partition column."""
    if not partition_column:
        return {"url": url, "query": query, **options}
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return {
        "url": url, "dbtable": f"({query}) t", "partitionColumn": partition_column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions), **options,
    }


def read_query(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    """Run a SQL query in a database over JDBC.

    Give ``partition_column, lower, upper, partitions`` for a parallel read;
    a plain query is fetched by a single task.
    """
    return normalize_missing(spark.read.format("jdbc").options(**query_options(url, query, **kwargs)).load())
