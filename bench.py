"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores and
BENCH_RUNS the timed runs per query, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from obs_engine.queries import QUERIES  # noqa: E402
from obs_engine.session import local_session  # noqa: E402

HEADLINE = [
    "staging_historic",
    "union_all_tagged",
    "activities",
    "model_on_forecast_only",
    "in_subquery_flag",
    "condition_count_by_month",
    "condition_count_by_year",
    "order_priority_counts_by_month",
    "avg_metrics_by_month",
    "rank_metrics_by_day",
    "rank_metrics_by_month",
    "rank_events_by_day",
    "rank_lines_by_flag",
    "rank_hot_groups",
    "top_cities",
    "top_customers",
    "extraction_window_first_load",
    "missing_keys",
    "merge_orders",
    "merge_orders_small_batch",
    "explode_forecast_days",
    "src_weather_json",
    "overwrite_roundtrip",
    "upsert_by_key",
    "upsert_duplicate_keys",
    "ledger_latest_status",
    "stream_upsert",
    "refresh_rank_by_month",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        first = run(spark, name, sf_dir)
        # Long queries are timed once more only; short ones after the warm-up.
        times = [run(spark, name, sf_dir) for _ in range(1 if first > 10 else runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
