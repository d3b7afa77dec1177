"""Time the headline queries: BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from tidemark.queries import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "event_date", "date_coverage", "validation_report", "key_uniqueness", "test_window_rows", "score_window",
    "score_window_udf", "baseline", "baseline_roundtrip", "join_report", "training_set", "split_anchor", "time_splits",
    "split_rows", "split_metrics_ols", "regression_metrics", "regression_metrics_by_group", "category_codes",
    "resolve_metric", "recent_runs", "best_run_pattern", "best_run_exact", "artifact_formats", "resolve_candidates",
    "champion_lookup", "decide_promotions", "aliases_after", "registration_results", "promotion_history_t0",
    "promotion_history_t2pct", "trial_grid", "median_prune", "rank_trials", "train_ml_families", "trial_sweep",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(cores)
        for name in names:
            timed(spark, name, sf_dir)  # warm-up: class loading and code generation
            seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
        spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cores, "runs": runs,
    }))


if __name__ == "__main__":
    main()
