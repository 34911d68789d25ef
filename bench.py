"""Seconds per registered query and per pipeline step, as one JSON line.

Every query starts from the test tables, including whatever it stores on the way. The pipeline
runs once from landed JSON pages, at the given size and at sf0.01; making those pages is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ordermill.fixtures.orders import TODAY
from ordermill.fixtures.queries import _land, queries
from ordermill.plans.pipeline import run_pipeline
from ordermill.session import build_session, scratch
from ordermill.sources import Warehouse


def pipeline_steps(spark, sf_dir: str) -> dict[str, dict]:
    folder = scratch(spark, "bench")
    run_pipeline(spark, f"{folder}/root", *_land(spark, sf_dir, packed=True), today=TODAY, packed=True)
    runs = Warehouse(spark, f"{folder}/root").runs().orderBy("run_at").collect()
    return {run.step_name: {"sec": float(run.duration_seconds), "rows": run.rows_processed} for run in runs}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "ordermill-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(query) -> float:
        started = time.monotonic()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.monotonic() - started, 3)

    registered = queries()
    timed(registered["country_revenue"])  # starts the JVM's compilers; not reported
    only = sys.argv[1:]
    seconds = {name: timed(query) for name, query in registered.items() if not only or name in only}
    steps = {} if only else pipeline_steps(spark, sf_dir)
    small = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    steps_small = pipeline_steps(spark, small) if steps and small != sf_dir and os.path.isdir(small) else {}
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "pipeline": steps,
                "pipeline_sf0.01": steps_small,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
