"""Time the headline reports and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every report
is run completely, without keeping its rows, and twice: the first run also pays for
loading and compiling code, which a long-lived session does once. ``queries`` and
``value`` are the second runs, ``first_runs`` has the first ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from purseflow import plans  # noqa: E402,F401
from purseflow.plans.registry import REPORTS  # noqa: E402
from purseflow.session import build_session, remove_staged  # noqa: E402

HEADLINE = [
    "run_summary",  # the end-to-end batch
    "ingested_rows",  # the batch ingestion
    "ingest_batch_log",
    "dashboard_kpis", "dash_categories", "dash_months", "dash_cities",
    "q2_category", "q4_top_merchants", "q7_heavy_users", "q8_wallet",
    "gst_inclusive_total", "describe_amount", "category_describe", "feature_corr", "replicate_11x",
    "join_inner_user", "join_left_user_counts", "city_revenue", "fraud_3x_user_avg", "sq_txn_vs_user_avg",
    "w_rank_category", "w_running_total", "w_rolling_sum",
    "clean_rows", "validate_summary", "dq_score", "dq_iqr", "dq_behavioural",
    "fact_load", "star_q1_city_tier", "upsert_latest", "snapshot_update", "stream_running_totals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = []
    for _ in range(2):
        times = {}
        for name in names:
            start = time.perf_counter()
            REPORTS[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        runs.append(times)
    first, times = runs
    n_raw = spark.read.parquet(f"{folder}/orders.parquet").count()
    line = {
        "metric": "headline reports, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "rows": n_raw,
        "first_runs": first,
    }
    if "ingested_rows" in times:
        line["ingest_rows_per_sec"] = round(n_raw / times["ingested_rows"])
    if "run_summary" in times:
        line["end_to_end_sec_per_100k_rows"] = round(times["run_summary"] / n_raw * 100_000, 3)
    print(json.dumps(line))
    remove_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
