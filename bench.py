"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3), BENCH_QUERIES (comma list; default: the headline set).  Each query runs end to end into Spark's ``noop``
sink (the whole plan executes, nothing is collected); the value reported per
query is the median wall time of the repeats, after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from tideline.plans import registry
    from tideline.session import local_session

    spark = local_session(cpus, app="tideline-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    qs = registry.headline()
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    if only:
        qs = {k: registry.queries()[k] for k in only}

    def run(fn):
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times, failed = {}, {}
    for name, fn in qs.items():
        try:
            run(fn)  # warm-up: JIT, Python workers, file listing caches
            times[name] = round(statistics.median(run(fn) for _ in range(repeats)), 3)
        except Exception as e:  # report the failure, keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum of median seconds over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
