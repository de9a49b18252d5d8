"""Benchmark: run the headline registered queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up query
runs first so JVM start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkloom.plans.registry import all_queries  # noqa: E402
from sparkloom.session import local_session  # noqa: E402

HEADLINE = [
    "run_query_spec",
    "agg_stats",
    "agg_median_mode",
    "pred_in_subquery",
    "pred_not_in",
    "top_k",
    "profile_columns",
    "text_vectors_hashing",
    "text_sentiment",
    "text_entities",
    "text_keywords",
    "cross_attention",
    "visual_feature_vector",
    "image_color_palette",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="sparkloom-bench")
    registry = all_queries()
    registry["run_query_spec"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        df = registry[name].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
