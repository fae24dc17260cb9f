"""Headline queries, timed: prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks.queries import QUERIES
from loyalspan.session import local_session

HEADLINE = (
    "clean_transactions",
    "daily_spend",
    "training_snapshot",
    "training_snapshot_all",
    "training_snapshot_events",
    "full_snapshot",
    "replace_snapshot",
    "dedup_guarded",
    "roc_auc",
    "youden_cutoff",
    "classification_report",
    "decile_capture",
    "clv_decile",
    "expected_purchases",
    "holdout_prediction",
    "pareto_predict",
    "clv_12m",
    "clv_36m",
    "udf_clv",
    "udf_probability_alive",
    "score_snapshot",
    "frequency_evaluation",
    "monetary_evaluation",
    "fit_mbg",
    "fit_pareto_nbd",
    "fit_gamma_gamma",
    "l2_search",
    "l2_search_spend",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = local_session(cores, shuffle_partitions=cores)
    # Start the workers and compile the common paths before the clock runs.
    QUERIES["training_snapshot"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
