"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwatch.catalog import QUERIES  # noqa: E402
from tillwatch.session import drop_scratch, get_spark  # noqa: E402

HEADLINE = [
    "transform_sales", "clean_fill", "interpolate", "aggregate", "aggregate_categories", "pivot_sum",
    "heatmap_product_month", "sales_histogram", "describe", "quantile_bounds", "median_abs_dev", "grouped_median",
    "top_products", "daily_sales", "complete_report", "rolling_mean", "temporal_anomaly", "lines_temporal_anomaly",
    "join_group_stats", "pattern_anomaly", "lines_pattern_anomaly", "outliers_iqr", "outliers_zscore",
    "outliers_modified_zscore", "anomaly_report", "isolation_forest", "kmeans_anomaly", "incremental_daily",
    "stage_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("tillwatch-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in HEADLINE:  # start-up and compilation are not what is timed
        QUERIES[name](spark, small if os.path.isdir(small) else folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_scratch(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
