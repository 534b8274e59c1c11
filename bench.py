"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (no driver collect); the
reported time is the median of 3 runs after one warm-up.  The incremental
pipeline (bronze -> silver -> gold over JSON landed from the tables) is timed three times
after a warm-up run, each replaying every landed file into a fresh output root, and the
gold refresh over the written silver three times; medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    # gold (G1-G4)
    "gold_billable_hours_by_matter_month", "gold_doc_activity_by_matter", "gold_matter_lifecycle",
    "gold_matter_summary",
    # dashboard datasets (D1-D6)
    "dash_kpis", "dash_monthly_revenue", "dash_by_practice", "dash_top_matters", "dash_doc_actions",
    "dash_kpis_extended",
    # questions (Q1-Q8)
    "q_top10_matters", "q_revenue_share_by_practice", "q_doc_events_last_week", "q_opened_never_closed",
    "q_avg_hours_by_practice", "q_top_timekeepers", "q_clients_by_doc_activity", "q_monthly_revenue_by_region",
)


def _run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from docketflow.plans.registry import BATCH_QUERIES
    from docketflow.session import get_session, new_work_dir
    from docketflow.streaming.pipeline import new_run_id, refresh_gold, run_pipeline
    from docketflow.streaming.registry import land_standin

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(app="docketflow-bench", cpus=cpus, shuffle_partitions=int(cpus))

    timings = {}
    for key in HEADLINE:
        _run(BATCH_QUERIES[key](spark, sf_dir))  # warm-up
        runs = [_run(BATCH_QUERIES[key](spark, sf_dir)) for _ in range(repeats)]
        timings[key] = round(statistics.median(runs), 3)

    pipeline = {}
    if os.environ.get("BENCH_PIPELINE", "1") == "1":
        work = new_work_dir(spark, "bench")
        t = time.perf_counter()
        land_standin(spark, sf_dir, f"{work}/landing")
        landed = time.perf_counter() - t
        # warm-up run into its own output root, then the timed run replays every landed file afresh
        run_pipeline(spark, f"{work}/landing", f"{work}/warmup", register=False)
        times = []
        for k in range(3):
            t = time.perf_counter()
            res = run_pipeline(spark, f"{work}/landing", f"{work}/out{k}", register=False)
            times.append(time.perf_counter() - t)
        elapsed, refreshes = statistics.median(times), []
        for _ in range(3):  # gold alone, over the silver that is written
            t = time.perf_counter()
            refresh_gold(spark, res.layout, new_run_id())
            refreshes.append(time.perf_counter() - t)
        lines = sum(res.bronze_input_lines.values())
        pipeline = {"land_sec": round(landed, 3), "pipeline_sec": round(elapsed, 3), "input_rows": lines,
                    "rows_per_sec": round(lines / elapsed, 1), "gold_refresh_sec": round(statistics.median(refreshes), 3)}

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "pipeline": pipeline,
        "spark": spark.version,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
