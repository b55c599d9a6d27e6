"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``,
forcing full evaluation with the ``noop`` sink (nothing is collected to the driver), and prints one
JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.plans.registry import QUERIES  # noqa: E402
from cartwheel.session import get_session  # noqa: E402

HEADLINE = [
    "interactions", "popular_items", "weighted_random", "tfidf_weights", "bm25_weights",
    "item_item_neighbours", "item_item_recs", "metric_means", "recall_curve", "prefilter_items",
    "top_without_fake", "fill_popular", "candidate_union", "pair_features", "chunk_assign",
    "similar_items_vectors", "similar_users", "content_based", "als_recs", "hybrid_fm_recs", "two_level_recs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # JVM start and first code generation are not query work: one small untimed read first
    t0 = time.time()
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).write.format("noop").mode("overwrite").save()
    warmup = round(time.time() - t0, 3)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()  # no query profits from another's cached intermediates
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "warmup_sec": warmup, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
