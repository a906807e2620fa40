"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is forced with a no-op write (full computation, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "eval_train_validate_test",   # naive Bayes default run (flagship)
    "feat_page_pipeline",
    "split_80_10_10",
    "agg_rating_stats",
    "topk_per_key",
    "fit_logistic_sgd",
    "fit_svm_sgd",
    "tune_grid_logistic",
    "tune_grid_nb",
    "fit_tree_binary",
    "fit_tree_regression",
    "rec_items_for_user",
    # the heavy ones: 100 steps, 60 configurations, 14 and 50 tree fits
    "tune_sweep_logistic",
    "tune_grid_svm",
    "tune_sweep_tree",
    "tune_grid_tree",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from orchard.plans.registry import QUERIES
    from orchard.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")))
    names = sys.argv[1:] or HEADLINE
    times = {}
    # warm the JVM (class loading, codegen caches) outside the timings
    QUERIES["agg_row_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
