"""Time every registered query; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPS (timed runs per query after one warm-up, default 3; one
where the warm-up takes over SLOW seconds, as whole pipelines and streams do),
BENCH_QUERIES (comma-separated subset, default all).

Each run materialises the whole result with the ``noop`` sink, so the
full plan executes on the executors and nothing is collected to the
driver. A query's time is the median of its timed runs; ``value`` is the
sum over queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


SLOW = 8.0


def main() -> None:
    from stationday.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, "stationday-bench", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))

    from stationday.plans.queries import QUERIES

    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    # JVM start-up, the first scan and the first shuffle belong to no query
    QUERIES["distinct_keys"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]
        runs = []
        try:
            left = reps + 1
            while left:
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                took, left = time.perf_counter() - t0, left - 1
                if left < reps:  # the first run warms the JVM and caches of this plan shape
                    runs.append(took)
                elif took > SLOW:
                    left = min(left, 1)
        except Exception as e:  # noqa: BLE001 - report the failure, time the others
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
            continue
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of per-query median seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
