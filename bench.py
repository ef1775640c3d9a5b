"""Times the registered queries and prints one JSON line.

Each query runs three times into a sink that keeps nothing; the median counts.
Landing the derived events and building the stored layers are timed on their own,
before the queries that read them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartlake import catalogue  # noqa: E402
from cartlake.session import build_session  # noqa: E402


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        # At this scale every table fits the default limit; a broadcast of orders would
        # leave the joins to the one task that scans a small file.
        spark__sql__autoBroadcastJoinThreshold="1m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    timings = {
        "land_bronze": seconds(lambda: catalogue.bronze(spark, folder)),
        "build_layers": seconds(lambda: catalogue.stored_layers(spark, folder)),
    }
    for name, query in catalogue.QUERIES.items():

        def run(query=query):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        timings[name] = statistics.median(seconds(run) for _ in range(repeats))

    events = catalogue.bronze(spark, folder).count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": os.path.basename(folder.rstrip("/")),
                "events": events,
                "stream_events_per_sec": round(events / timings["stream_to_bronze"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
