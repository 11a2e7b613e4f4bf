"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to a no-op sink twice and the faster run counts, so that code
compilation in a fresh JVM does not hide the work.
"""

from __future__ import annotations

import json
import os
import sys
import time

from amperine.plans.registry import queries
from amperine.session import build_session

HEADLINE = [
    "agg_1m", "agg_15m", "agg_1h", "agg_1d", "rollup_1h", "model_input", "quality_monitor",
    "inject_anomaly", "fit_thresholds", "rule_score", "score_rows", "score_with_forest",
    "anomaly_events", "daily_kpi", "insights", "report_headline", "dispatch_pass",
    "send_log_merge", "forecast_output", "stream_agg_15m",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in chosen:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of best runs", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
