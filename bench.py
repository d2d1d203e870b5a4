"""Headline queries at one scale; prints one JSON line.

Each query runs to completion into a sink that keeps nothing. The first run warms the JVM; the
best of the following ones counts. The sort timings leave loading out, as the published sort
figures do: the records are cached first.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixture_queries import QUERIES
from tallyroute.operators import ordering
from tallyroute.session import local_session

HEADLINE = [
    "overview_kpis", "dataset_profile", "correlation_matrix", "column_stats", "segment_distribution",
    "price_quantity_fit", "customer_search_page", "customer_search_totals", "orders_deep_page",
    "top_orders_by_price", "engineered_features", "encoded_segments", "order_row_errors", "batch_scores",
    "batch_summary", "exact_split", "split_tables", "threshold_sweep", "class_report", "roc_auc", "roc_points",
    "feature_importance", "ranked_explanations", "directed_last_edge", "all_pairs_distance",
    "best_origin_per_metric", "route_by_distance", "supply_distances", "csv_to_parquet", "boosted_scores",
]
SORT_SIZES = (1_000, 10_000, 100_000)
REPEATS = 2


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(run, repeats: int = REPEATS) -> float:
    run()
    timings = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        timings.append(time.perf_counter() - start)
    return min(timings)


def sort_timings(spark: SparkSession, sf: str) -> dict[str, float]:
    """Sort N text records by a text column, ties in input order."""
    records = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("row_index"),
        F.col("o_orderkey").cast("string").alias("ID"),
        F.md5(F.col("o_orderkey").cast("string")).alias("FirstName"),
        F.col("o_orderpriority").alias("LastName"),
    )
    timings = {}
    for n in SORT_SIZES:
        head = ordering.first_rows(records, n).cache()
        rows = head.count()
        if rows == n:
            ordered = ordering.sort_records(head, "FirstName", tie=["row_index"])
            timings[f"sort_records_{n}"] = best_of(lambda: finish(ordered), 5)
        head.unpersist()
    return timings


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cpus=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    timings = sort_timings(spark, sf)
    for name in HEADLINE:
        timings[name] = best_of(lambda: finish(QUERIES[name](spark, sf)))
    rounded = {name: round(seconds, 4) for name, seconds in timings.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
