"""Benchmark: the headline views at $BENCH_SF_DIR on local[$BENCH_CPUS].

seconds. Before every run the context's derived caches (model fits, forecasts, panel) are
dropped, so a model view really fits its model each time; only the materialised raw fact,
row fact and weekly table are reused. Their one-off cost (source join, cleaning, allocation,
Parquet writes, cold JVM included) is reported as ``row_fact``. Results go to Spark's noop
sink. ``calibration_sec`` is the time of a fixed loop. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "breakdown_media_type", "weekly_true_sales", "allocated_sales", "reconciliation", "kpi_summary",
    "breakdown_all_dims", "efficiency_all_dims", "top_creatives", "correlation_matrix", "describe_metrics",
    "quality_summary", "fanout_evidence", "row_ratios", "model_dataset", "time_split", "naive_metrics",
    "ridge_holdout", "forest_holdout", "recursive_forecast", "insight_facts", "streaming_weekly_kpi",
]
# run once, without a warm-up: 500 rounds of boosting, the six models and five folds of the tournament
ONCE = ["gbt_holdout", "huber_boost_holdout", "leaderboard", "champion_forecast", "panel_leaderboard", "panel_shap_global"]
KEEP = {"champion_forecast", "panel_shap_global"}       # these go on with the fits of the view before
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
DERIVED = ["_suite", "_panel", "_panel_suite", "_quality"]   # per-context caches dropped before every run


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from mixlens.plans.catalog import QUERIES
    from mixlens.plans.context import context
    from mixlens.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times, failed = {}, []
    t0 = time.thread_time()
    sum(range(20_000_000))
    calibration = round(time.thread_time() - t0, 3)         # a fixed loop, to compare machines and rounds
    t0 = time.time()
    ctx = context(spark, sf_dir)
    ctx.rows()
    ctx.weekly()
    times["row_fact"] = round(time.time() - t0, 3)

    def run(name):
        for attr in DERIVED:
            if hasattr(ctx, attr) and name not in KEEP:
                setattr(ctx, attr, None)
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()    # every row, none to the driver
        return time.time() - t

    for name in HEADLINE:
        try:
            run(name)                                        # warm-up
            times[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        except Exception as e:  # noqa: BLE001 - record and keep measuring the others
            failed.append(name)
            print(f"{name} failed: {str(e)[:200]}", file=sys.stderr)
    for name in ONCE:
        try:
            times[name] = round(run(name), 3)
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"{name} failed: {str(e)[:200]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "failed": failed, "runs": RUNS, "warmup": 1, "calibration_sec": calibration,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
