"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected) in a fresh local session; prints one JSON
line with per-query seconds and their sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sentences",
    "tfidf",
    "tfidf_knn",
    "knn_edges",
    "weighted_degree",
    "token_pack",
    "extractive_chunks",
    "community_summary",
    "rouge1",
    "answer",
    "train_token_ids",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from loomgraph.plans import QUERIES
    from loomgraph.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm the JVM and the Python workers once, outside the timings: this query
    # runs Python on tiles of all vectors
    QUERIES["l2_pairs"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
