"""Stage and task times from a Spark event log (no UI, no server).

Usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [--top N]

Per job group (bench.py sets one per query): wall time of its jobs, and its
slowest stages with task count, summed task time, shuffle read/write bytes and
spilled bytes -- where to look when a query is slower than expected.
"""

from __future__ import annotations

import collections
import io
import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):
        import zstandard
        with open(f, "rb") as fh, zstandard.ZstdDecompressor().stream_reader(fh) as r:
            yield from io.TextIOWrapper(r, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _events(path: str):
    """Events of a log file, a rolling log folder (``eventlog_v2_*``) or a folder of either."""
    if os.path.isfile(path):
        files = [path]
    else:
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if f.startswith(("events_", "local-", "app-", "application_")))
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    args = sys.argv[1:]
    top = int(args[args.index("--top") + 1]) if "--top" in args else 3
    path = args[0]
    job_group, job_time, stage_job = {}, {}, {}
    stages = {}
    for e in _events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            job_group[e["Job ID"]] = props.get("spark.jobGroup.id", "-")
            job_time[e["Job ID"]] = [e["Submission Time"], None]
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in job_time:
            job_time[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages[info["Stage ID"]] = {
                "name": info.get("Stage Name", "")[:60],
                "tasks": info.get("Number of Tasks"),
                "ms": (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0),
                "task_ms": int(acc.get("internal.metrics.executorRunTime") or 0),
                "shuffle_read": int(acc.get("internal.metrics.shuffle.read.localBytesRead") or 0)
                + int(acc.get("internal.metrics.shuffle.read.remoteBytesRead") or 0),
                "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten") or 0),
                "spill": int(acc.get("internal.metrics.diskBytesSpilled") or 0),
            }
    by_group = collections.defaultdict(list)
    for job, group in job_group.items():
        by_group[group].append(job)
    for group, jobs in by_group.items():
        wall = sum((t[1] or t[0]) - t[0] for j in jobs for t in [job_time[j]])
        print(f"{group}: {len(jobs)} jobs, {wall} ms in jobs")
        own = sorted((s for sid, s in stages.items() if stage_job.get(sid) in jobs), key=lambda s: -s["ms"])
        for s in own[:top]:
            print(f"    {s['ms']:6d} ms  {s['tasks']:4d} tasks  task {s['task_ms']:6d} ms  "
                  f"shuffle r/w {s['shuffle_read']:>10d}/{s['shuffle_write']:>10d} B  spill {s['spill']} B  "
                  f"{s['name']}")


if __name__ == "__main__":
    main()
