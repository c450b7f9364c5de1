"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
(shuffle partitions: $BENCH_SHUFFLE_PARTITIONS, default 2 x CPUs)
and print one JSON line with per-query seconds.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected).  Model queries include their fit jobs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinity.plans.catalog import registry  # noqa: E402
from affinity.session import build_session  # noqa: E402

HEADLINE = [
    "connectivity_index",
    "avg_connectivity_coords",
    "max_connectivity_coords",
    "border_effect",
    "hist_weight",
    "title_match",
    "level_by_unit",
    "unit_profile",
    "pair_features",
    "gap_correlation",
    "regression_one_coef",
    "regression_rmse",
    "attitude_nb_accuracy",
    "connectivity_nb_accuracy",
    "adjacency_neighbors",
    "parse_results_rows",
    "union_partitions",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    reg = registry()
    # warm-up on the next smaller tables (JVM JIT, codegen caches), not
    # timed; it uses its own binding, so nothing of the timed scale is cached
    base = os.path.dirname(sf_dir.rstrip("/"))
    smaller = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}.get(os.path.basename(sf_dir.rstrip("/")))
    warm = os.path.join(base, smaller) if smaller else None
    if warm and os.path.isdir(warm):
        for name in names:
            run(reg[name](spark, warm))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(reg[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
