"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)

``build_mart`` is the whole chain from raw rides to the stored star, ``refresh_mart`` a run that finds
nothing new. The other entries are registered queries, each the better of two runs.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridemart.plans.mart import refresh_mart  # noqa: E402
from ridemart.queries import STORED_QUESTIONS, build_mart, registered, stored_mart  # noqa: E402
from ridemart.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STEPS = (
    "parse_lines", "silver_rides", "dedup_first_rides", "new_trips_anti", "new_trips_small_batch",
    "silver_union", "fact_trip", "dim_date", "dim_geography", "band_range_join", "stream_silver",
)


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, "ridemart-bench")

    def run(name: str) -> None:
        registered()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    spark.range(1000).count()
    timings = {"build_mart": min(seconds(lambda: build_mart(spark, SF_DIR)) for _ in range(2))}
    paths = stored_mart(spark, SF_DIR)
    timings["refresh_mart"] = seconds(lambda: refresh_mart(spark, paths))
    for name in (*STEPS, *STORED_QUESTIONS):
        timings[name] = min(seconds(lambda: run(name)) for _ in range(2))
    timings = {name: round(value, 3) for name, value in timings.items()}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
