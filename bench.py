"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from swipelens.plans.queries import QUERIES
from swipelens.session import local_session, scratch

HEADLINE = [
    "feature_engineering", "recent_count_sum", "recent_count_sum_dense", "card_profile_zscore",
    "describe_numeric", "correlation_matrix", "mutual_information", "fraud_rate_by",
    "interpolate_bfill", "time_based_split", "balance_data", "target_encode", "encoded_matrix",
    "rank_metrics", "cost_threshold", "train_logistic",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Start-up and code generation are not part of any query.
    for name in ("feature_engineering", "rank_metrics"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        with scratch(spark):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
