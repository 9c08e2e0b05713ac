"""The measuring tools: event-log stage times and plan summaries."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stage_times_reads_a_plain_event_log(tmp_dir):
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": 1000, "Stage IDs": [0, 1],
         "Properties": {"spark.jobGroup.id": "c8_delta"}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": 0, "Stage Name": "scan", "Number of Tasks": 4, "Submission Time": 1000,
            "Completion Time": 1300, "Accumulables": [
                {"Name": "internal.metrics.executorRunTime", "Value": 900},
                {"Name": "internal.metrics.shuffle.write.bytesWritten", "Value": 1234}]}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": 1, "Stage Name": "join", "Number of Tasks": 2, "Submission Time": 1300,
            "Completion Time": 1400, "Accumulables": [
                {"Name": "internal.metrics.shuffle.read.localBytesRead", "Value": 1234},
                {"Name": "internal.metrics.diskBytesSpilled", "Value": 7}]}},
        {"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": 1450},
    ]
    path = os.path.join(tmp_dir, "eventlog")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "stage_times.py"), path],
                         capture_output=True, text=True, check=True).stdout.splitlines()
    assert out[0] == "c8_delta: 1 jobs, 450 ms in jobs"
    assert "300 ms" in out[1] and "4 tasks" in out[1] and "0/      1234 B" in out[1] and "scan" in out[1]
    assert "spill 7 B" in out[2] and "join" in out[2]


def test_plan_summary_counts_operators():
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from plan_summary import summarize

    plan = ("+- BroadcastHashJoin LeftOuter\n   :- Exchange hashpartitioning(cpe, 8)\n"
            "   +- BroadcastExchange HashedRelationBroadcastMode\n      +- MapInPandas\n"
            "         +- SortAggregate\n   Scan parquet PushedFilters: [IsNotNull(ts)]")
    s = summarize(plan)
    assert (s["shuffles"], s["broadcasts"], s["bhj"], s["smj"], s["sort_agg"], s["python"], s["pushed"]) == \
        (1, 1, 1, 0, 1, 1, True)
