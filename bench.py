"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line.

Each query runs once to warm up, then $BENCH_RUNS times (default 2); its result is counted in full through a job without
output, and the median is reported. $BENCH_QUERIES may name the queries to run, separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalog import load  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_segment_summary", "group_summary", "group_statistics_on_rows", "left_join_customers", "values_absent_from_reference",
    "first_row_per_key", "exact_quartiles", "correlation_pairs", "word_scores", "parquet_in_chunks", "resetting_running_sum",
    "forward_filled_values", "centered_rolling_mean", "daily_resample", "datetime_pipeline", "day_of_year_climatology",
    "validation_counts", "observed_step_summary", "iqr_clipped", "scaled_three_ways", "target_encoded", "anova_scores",
    "mutual_information_with_class", "five_nearest_embeddings", "stratified_folds", "random_under_sampled", "roc_auc",
    "classification_report", "logistic_regression_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session("bench", cpus)
    registry = load()
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        samples = []
        for i in range(runs + 1):
            started = time.monotonic()
            registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.monotonic() - started)
            spark.catalog.clearCache()
        times[name] = round(statistics.median(samples), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
