"""Headline-query benchmark.

Runs the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed in
full through the ``noop`` sink (every row computed, nothing collected); the
reported time is the best of ``$BENCH_REPEAT`` runs (default 2) after one
warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlake.plans import catalog  # noqa: E402
from meterlake.session import build_session  # noqa: E402

HEADLINE = ["c8_delta", "d1_last_point", "d2_last_insert", "f3_load_full", "f4_load_delta",
            "d3_pivot_fields", "c3_month_select", "g2_status_update", "g5_surrogate_id",
            "c7_missing_periods", "a1_read_workbooks", "l1_run_load", "i1_stream_load", "i2_stream_delta_state"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    scratch = tempfile.mkdtemp(prefix="meterlake-bench-")
    extra = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.local.dir": scratch,
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
    }
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")   # stage/task times: tools/stage_times.py
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    names = [n for n in HEADLINE if n in catalog.QUERIES]

    def run(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)     # event-log jobs carry the query name
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing, Python workers
        run(n)
    times = {n: round(min(run(n) for _ in range(repeat)), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
