"""Time the registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line.  Every query runs whole into Spark's ``noop`` sink:
the median of up to ``$BENCH_RUNS`` timed runs, fewer for queries of many seconds, after one cold run, whose time is
reported apart.  ``$BENCH_QUERIES`` (comma separated) selects queries; the default is all of them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.registry import QUERIES
from opinara.session import get_session

#: Seconds of timed runs after which a query is not run again.
LONG = 5.0


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen and chosen != "all" else list(QUERIES)

    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in names:

        def run(name: str = name) -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        cold[name] = round(seconds(run), 3)
        times = [seconds(run)]
        while len(times) < runs and sum(times) < LONG:
            times.append(seconds(run))
        warm[name] = round(statistics.median(times), 3)
        print(f"{name:36s} cold {cold[name]:8.2f}  warm {warm[name]:8.2f}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total seconds over the listed queries, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
