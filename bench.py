"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no rows pulled to
the driver): one warm-up pass, then the median of $BENCH_REPEAT runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martlens.plans import QUERIES  # noqa: E402
from martlens.session import local_session  # noqa: E402


def run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="martlens-bench")
    names = [n for n in QUERIES if not only or n in only]
    for n in names:  # warm-up: JIT, file listing, codegen caches
        run(QUERIES[n](spark, sf_dir))
    per_query = {}
    for n in names:
        per_query[n] = round(statistics.median(run(QUERIES[n](spark, sf_dir)) for _ in range(repeat)), 4)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 4),
        "value_first_37": round(sum(v for n, v in per_query.items() if n in list(QUERIES)[:37]), 4),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "machine": platform.machine(),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
