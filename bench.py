"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full through the no-op sink (all partitions
computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "l6_segment_errors_decile",   # flagship: OOF ridge -> errors -> deciles -> segments
    "g4_fold_summary",
    "g5_run_candidates",
    "d14_feature_engineer",
    "c5_mode_imputer",
    "c3_group_median_imputer",
    "k1_numeric_drift",
    "k2_categorical_drift",
    "k5_psi_floor",
    "k9_drift_summary",
    "l8_risk_table",
    "l13_error_correlates",
    "m4_histogram",
    "m6_spearman",
    "i4_typicality_score",
    "i7_percentile_rank",
    "h7_resolve",
    "f8_blend_weighted",
    "o1_stratified_sample",
    "a1_read_table_csv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hearth.plans.registry import all_queries
    from hearth.session import get_spark

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = get_spark(master=f"local[{cpus}]", app="hearth-bench", shuffle_partitions=parts)
    qs = all_queries()
    names = [n for n in HEADLINE if n in qs]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in names if re.search(only, n)]
    # warm-up on the smallest data set (JIT, codegen caches, ML class loading);
    # nothing computed here is reused by the timed runs, which read sf_dir
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for n in ("g1_assign_folds", "l6_segment_errors_decile", "k1_numeric_drift"):
        if os.path.isdir(warm):
            qs[n](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        df = qs[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
