"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then twice; the smaller time counts. The stored tables of the loan book are
written during the warm-up, as they would be in service, and the full feature build is timed as a query of its own.
A query that fits a model counts with its first call, because later ones read the finished fit.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arrears.plans.catalog import catalog  # noqa: E402

HEADLINE = [
    "stage_loans", "build_features", "validation_report", "score_drift_months", "feature_drift_values_only",
    "ranking_rollup", "binary_metrics_by_run", "reliability_bins", "alert_score_p90", "alert_numeric_mean",
    "dash_risk_bands", "dash_score_trend", "dash_feature_drift", "dash_summary", "cutoff_what_if",
    "implied_rate_report", "direction_check", "top_reasons", "reason_summary", "refresh_monitoring", "train_and_score",
]
FITTING = {"train_and_score"}


def run(build, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("arrears-bench")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    built = catalog()
    times = {}
    for name in HEADLINE:
        first = run(built[name], spark, folder)
        later = [run(built[name], spark, folder) for _ in range(0 if name in FITTING else 2)]
        times[name] = round(min(later, default=first), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


if __name__ == "__main__":
    main()
