"""Benchmark the headline queries.

Runs each query end to end into Spark's ``noop`` sink (the whole plan executes, nothing
is collected to the driver) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints
one JSON line. One untimed warm-up pass first (JIT / Python workers), then the best of
``$BENCH_REPEATS`` timed runs per query. Query plans over the input tables are built
once per session, but materialized intermediates (the document index) are rebuilt inside
every timed run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from distillery.plans.catalog import QUERIES  # noqa: E402
from distillery.sources.fixtures import reset_materialized  # noqa: E402
from distillery.session import build_session  # noqa: E402

HEADLINE = [
    "pair_cosine",
    "hard_negative_triplets",
    "soft_label_triplets",
    "rerank_report",
    "compare_runs",
    "random_negative_triplets",
    "distill_kl",
    "margin_mse",
    "yes_no_logit",
    "samples_to_pairs",
    "truncate_suffix",
    "missing_vector_report",
]
#: Timed as well, apart from the headline total, which stays comparable between rounds.
OTHERS = [
    "document_soft_label_triplets",
    "document_hard_negatives",
    "embed_texts_pandas",
    "teacher_logits",
    "hot_query_metrics",
    "training_shards",
    "file_margin_triplets",
    "file_random_triplets",
]


def driver_memory() -> str:
    """Heap for the local-mode driver: ``$BENCH_DRIVER_MEMORY`` or 60% of physical memory
    (at most 16g), so the bench also fits small containers."""
    if os.environ.get("BENCH_DRIVER_MEMORY"):
        return os.environ["BENCH_DRIVER_MEMORY"]
    try:
        with open("/proc/meminfo") as f:
            total_kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal"))
        return f"{max(1, min(16, int(total_kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE + OTHERS
    spark = build_session(
        f"local[{cpus}]",
        app_name="distillery-bench",
        shuffle_partitions=cpus * 2,
        extra_conf={"spark.driver.memory": driver_memory()},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:  # warm-up
        run(QUERIES[name](spark, sf_dir))
    times = {}
    for name in names:
        best = None
        for _ in range(repeats):
            reset_materialized()  # every timed run rebuilds materialized intermediates
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(t for n, t in times.items() if sys.argv[1:] or n in HEADLINE), 3),
        "unit": "sec",
        "queries": {n: t for n, t in times.items() if sys.argv[1:] or n in HEADLINE},
        "other_queries": {} if sys.argv[1:] else {n: times[n] for n in OTHERS},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
