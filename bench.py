"""Wall time of the headline queries, as one JSON line.

Each query is evaluated in full (every row and column of its result) by the no-op sink; its time is
the median of the timed runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "claims_dedup",
    "lag_stats",
    "lag_labels",
    "lag_filter_iqr",
    "monthly_panel",
    "panel_quality",
    "weekly_panel",
    "month_upsert",
    "series_documents",
    "rolling_psi",
    "centred_changepoints",
    "peaks",
    "cusum_flags",
    "guard_table",
    "naive_forecast",
    "rolling_cv",
    "unit_root",
    "series_metrics",
    "mase",
    "kpi_gate",
    "reliability_score",
    "residual_diagnostics",
    "bias_map_series",
    "staged_correction",
    "ews_report",
    "ews_report_changepoints",
    "ews_v1",
    "pr_summary",
    "sarima_select",
    "model_training",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "file:///tmp/checkpoints/bench"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from panelwright import catalog

    times = {}
    for name in chosen:
        samples = []
        for i in range(runs + 1):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - began)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
