"""Time the registered queries end to end and print one JSON line.

The pipeline's stores are first derived from the whole tables of
``$BENCH_SF_DIR`` (reported as ``landing_sec``, which also warms the JVM). Then
every query is timed once, with its full result going to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidewise.plans import landing
from tidewise.plans.queries import QUERIES
from tidewise.session import build_session


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    landing.build_all(spark, sf_dir)
    landing_sec = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in names or list(QUERIES):
        start = time.perf_counter()
        _run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}
    print(json.dumps({**line, "landing_sec": landing_sec}))
    spark.stop()


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main(sys.argv[1:])
