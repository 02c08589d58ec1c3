"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. Every query is
run to the end into a sink that discards the rows; the time is the best of two runs.
"""

from __future__ import annotations

import json
import os
import time

from tidewheel.plans.catalogue import QUERIES
from tidewheel.session import local_session

HEADLINE = (
    "profile_batch",
    "clean_batch",
    "dedup_first",
    "quality_report",
    "flatten_snapshot",
    "event_digest",
    "json_decode",
    "validate_audit",
    "upsert",
    "feature_history",
    "test_summary",
    "latest_features",
    "point_in_time",
    "nearest_asof",
    "monitor_metrics",
    "station_breakdown",
    "psi",
    "monitor_decision",
    "monitor_backfill",
    "backfill_decisions",
    "chrono_split",
    "regression_scores",
    "score_requests",
    "fit_model",
)


def run() -> dict:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    return {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }


if __name__ == "__main__":
    print(json.dumps(run()))
