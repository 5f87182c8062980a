"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON
line.  Each query's full plan is executed with the ``noop`` sink (no
driver collect), after one warm-up scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferrite.queries import REGISTRY  # noqa: E402
from ferrite.session import build_session  # noqa: E402

HEADLINE = [
    "kpis", "null_profile", "describe", "correlation_matrix", "histogram", "box_stats",
    "stratified_split", "fold_assignment", "oversample", "impute_scale_encode",
    "confusion", "roc_auc_ap", "threshold_sweep", "model_comparison",
    "permutation_importance", "lr_score", "smote", "rebalancing_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "ferrite-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    REGISTRY["readings_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        REGISTRY[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
