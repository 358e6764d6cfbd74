"""Time the headline queries and print one JSON line.

The derived input tables are stored before; their time is given on its own. The
first query that needs a stored fact includes building it. Results go to the
no-op sink: all rows are computed, none are collected.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workload.derive import DERIVED, stored
from workload.queries import QUERIES

HEADLINE = [
    "q_segments",
    "q_segment_fact",
    "q_wide",
    "q_serving_segments",
    "q_dim_airline",
    "q_dim_flight_details",
    "q_dim_date",
    "q_dimensions",
    "q_star_fact",
    "q_lookup_normalized",
    "q_partition_scan",
    "q_itinerary_search",
    "q_itinerary_requests",
    "q_itinerary_packed",
    "q_cheapest20",
    "q_one_transfer",
    "q_two_transfer",
    "q_connections",
    "q_connections_same_day",
    "q_one_transfer_all",
    "q_connections_all",
    "q_clean_path",
    "q_fare_features",
    "q_best_time_label",
    "q_route_rule",
    "q_recommend",
    "q_stitched_share",
    "q_feature_vectors",
    "q_train_score",
    "q_stump_score",
    "q_extract_select",
]


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="skyledger-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skyledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    start = time.perf_counter()
    for name in DERIVED:
        stored(spark, sf_dir, name).count()
    derive = time.perf_counter() - start
    for name in HEADLINE:
        times[name] = round(run(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "derive_inputs": round(derive, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
