"""Headline-query benchmark.

Runs each headline query from the registry on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; every query is fully
executed through the ``noop`` sink (no driver collect), warm, and the
median of 3 runs is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "b1_revenue_by_type", "b1_top_items", "a_flag_status_summary", "j_anti_customers_no_urgent",
    "j_order_lines_by_priority", "w_top3_orders_per_customer", "w_abc_classes",
    "a_brand_share_top5", "b11_delivery_cost", "b5_return_rate_type_brand",
    "b22_price_vs_market", "b18_funnel", "w_gaps_between_events", "s_series_features",
    "n_clean_word_count", "i_null_counts", "d_box_stats", "g_star_pattern",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from lodestar.plans.registry import load_all
    from lodestar.session import get_session
    spark = get_session("lodestar-bench", f"local[{cpus}]", int(cpus) * 2)
    entries = load_all()
    out = {}
    failed = []
    for name in HEADLINE:
        times = []
        try:
            for _ in range(runs + 1):                  # first run warms up
                t0 = time.perf_counter()
                entries[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report, keep measuring the rest
            failed.append(name)
            print(f"bench: {name} failed: {str(e)[:200]}", file=sys.stderr)
            continue
        out[name] = round(statistics.median(times[1:]), 3)
    try:
        extra, rates = baseline_comparisons(spark, sf_dir, runs)
    except Exception as e:  # noqa: BLE001
        print(f"bench: baseline comparisons failed: {str(e)[:200]}", file=sys.stderr)
        extra, rates = {}, {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": {**out, **extra}, "sf": sf,
                      "throughput_vs_baseline": rates, "failed": failed}))


def baseline_comparisons(spark, sf_dir, runs):
    """
    (1.5 M rows, "1-2 min" with numpy) and the log-store write rate
    (9,210 rows/s). Same row counts / workload shape, on Spark."""
    import uuid
    from lodestar.session import scratch_dir
    from lodestar.sources.files import clustered_log
    from lodestar.sources.generator import generate_churn
    from lodestar.tables import load
    n_churn = 1_500_000
    events = load(spark, sf_dir, "events")
    n_events = events.count()

    def churn():
        generate_churn(spark, n_churn, seed=42).write.format("noop").mode("overwrite").save()

    def log_write():
        path = scratch_dir(spark, f"bench-log-{uuid.uuid4().hex}")
        clustered_log(events, "user_id", "ts").write.parquet(path)

    times = {}
    for name, fn in (("s19_generate_churn_1500000", churn), ("s17_log_table_write", log_write)):
        ts = []
        for _ in range(runs + 1):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(ts[1:]), 3)
    rates = {
        "churn_rows_per_sec": round(n_churn / times["s19_generate_churn_1500000"]),
        "churn_rows_per_sec_baseline": round(n_churn / 90),          # "about 1-2 min"
        "log_rows_per_sec": round(n_events / times["s17_log_table_write"]),
        "log_rows_per_sec_baseline": 9210,
    }
    return times, rates


if __name__ == "__main__":
    main()
