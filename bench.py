"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the input, BENCH_CPUS the number of local
threads. Each query is built and run to the end into Spark's ``noop`` sink, after one small
query that starts the engine.
"""

import json
import os
import sys
import time

from panelloom.catalog import load
from panelloom.session import local_session

HEADLINE = [
    "rolling_var_cov_beta", "ttm_flow", "growth_rates", "rolling_impute", "asof_forward",
    "coalesce_merge", "dense_grid", "universe_top_n", "cross_section_quantile",
    "cross_section_zscore", "group_ratio_impute", "soft_winsorize", "describe",
    "yeo_johnson_exponents", "time_series_folds", "build_raw_panel", "build_features",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    queries = load().QUERIES
    queries["distinct_count"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
