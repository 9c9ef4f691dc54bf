"""Time all queries: one warm-up run, then best of all runs, results computed in full and thrown away; streams and writers run once.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the number of local tasks, BENCH_ROUNDS the rounds,
BENCH_QUERIES (comma separated) other queries.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowtables.queries import QUERIES  # noqa: E402
from flowtables.session import build_session  # noqa: E402

# These write tables and keep state, so one run each has to do.
ONCE = [name for name in QUERIES if name.startswith("stream_") or name in ("upsert_table", "row_counters")]
HEADLINE = list(QUERIES)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        best = None
        for _ in range(1 if name in ONCE else rounds + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
