"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS].

Prints a JSON line after every query; the last is the result: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "knn",              # exact blocked kNN join
    "view_fusion",      # six views x k-set graph build + fusion
    "laplacian",
    "ngrams",           # whole-text n-grams + most common gram
    "cluster_profile",  # grouped profile + rule columns
    "sibling_dedupe",
    "spectral_embed",   # Broad-level embedding of all rows
    "run_level",        # one full clustering level
    "hierarchy",        # Broad -> Sub -> Niche
    "taxonomy",         # end to end: clusters, names, export
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from mvtax.catalog import QUERIES
    from mvtax.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="mvtax-bench", shuffle_partitions=int(cpus))
    times = {}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    for name in only or HEADLINE:
        fn = QUERIES[name]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
        # after every query, so that a run that is stopped keeps what it measured; the last line is the whole
        print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                          "queries": times, "sf": float(m.group(1)) if m else sf_dir}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
