"""Headline queries on one machine; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # grouped forecasts: the one workload with published times (500 series)
    "m11_series_forecast", "m12_allocated_forecast", "m13_backtest_rmse",
    # stock
    "i1_current_stock", "i1_current_stock_each_store", "i3_transaction_documents_round_trip",
    # customer value and propensity
    "m1_rfm", "m2_rfm_holdout", "m3_rfm_scores", "m19_household_features", "m23_purchase_labels",
    "m24_feature_backfill", "m26_classifier_selection", "m8_retention_model",
    # change data
    "d4_change_feed", "d5_latest_state", "d5_validity_intervals", "d6_clustered_layout",
    # spatial
    "g3_tessellate", "g6_trips_between_zones", "g7_zone_month_summary",
    # relational
    "p13_discounts_and_list_price", "j7_equi_join_with_range_condition", "a5_several_distinct_counts",
    "w3_next_30_days", "o2_top_groups", "q1_warn",
    # streams and end-to-end jobs
    "j1_stream_static_left", "t5_watermark_and_keyed_dedup", "t9_version_history", "l3_inventory",
]


def stage_inputs(t) -> None:
    """Files that several queries read are written before the clock runs."""
    from millrace.queries import q_customers, q_streams
    q_customers.tx(t)
    q_streams.trip_files(t)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from millrace.queries import QUERIES
    from millrace.queries.registry import Tables
    from millrace.session import local_session

    spark = local_session(cpus, scratch=tempfile.mkdtemp(prefix="bench-"))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start-up
    start = time.perf_counter()
    stage_inputs(Tables(spark, sf_dir))
    staging = round(time.perf_counter() - start, 3)
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    out = {
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "staging_seconds": staging,
    }
    if "m11_series_forecast" in times:
        out["forecast_models_per_second"] = round(500 / times["m11_series_forecast"], 1)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
