"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], noop sink.

Prints one JSON line: {"metric", "value" (sum of per-query medians, seconds), "unit",
"queries": {name: median seconds}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("loc_clean", "attr_unified", "dim_users", "dq_suite")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = tuple(os.environ["BENCH_QUERIES"].split(",")) if os.environ.get("BENCH_QUERIES") else HEADLINE

    from dimloom.plans.catalog import queries
    from dimloom.session import local_session
    from dimloom.sources.adapters import sources_from_driver

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    if os.environ.get("BENCH_SALTING"):
        spark.conf.set("spark.dimloom.skew.salting", os.environ["BENCH_SALTING"])
    q = queries()
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    t = time.perf_counter()
    dict(sources_from_driver(spark, sf_dir))  # stages all of them
    staging = time.perf_counter() - t
    for name in names:
        samples = []
        for i in range(runs + 1):  # first run warms the JVM and file listing
            t = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t)
            else:
                first[name] = round(time.perf_counter() - t, 3)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "staging_sec": round(staging, 3),  # the 13 sources written once as Parquet
        "first_run_sec": first,  # compiles code, counts hot keys and, for dq_suite, builds the models
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
