"""Summarise the physical plan of registered queries, as planned (before AQE re-plans).

Usage: python tools/plan_summary.py [sf_dir] [name ...]

Counts shuffles, broadcasts, join strategies, Python operators and sort-based
aggregates, and reports whether the scans carry pushed filters. AQE may still
coalesce partitions, split skewed ones or turn a shuffled join into a
broadcast from measured sizes at run time. Queries whose work happens while
they are built (streams, loads, table inserts) show only the read-back of
their output.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.plans import catalog  # noqa: E402
from meterlake.session import build_session  # noqa: E402

PYTHON_NODES = ("MapInPandas", "FlatMapGroupsInPandasWithState", "ArrowEvalPython", "BatchEvalPython")


def summarize(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange RoundRobinPartitioning|\bExchange SinglePartition|"
                                   r"\bShuffleQueryStage", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange|BroadcastQueryStage", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "sort_agg": plan.count("SortAggregate"),
        "python": sum(plan.count(n) for n in PYTHON_NODES),
        "pushed": "PushedFilters: [" in plan and "PushedFilters: []" not in plan,
    }


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or sorted(catalog.QUERIES)
    scratch = tempfile.mkdtemp(prefix="meterlake-plans-")
    spark = build_session("local[8]", 16, extra={"spark.local.dir": scratch,
                                                 "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    print(f"{'query':28s} shuffles broadcasts SMJ BHJ sortAgg python pushed")
    for n in names:
        df = catalog.QUERIES[n](spark, sf)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"{n:28s} {s['shuffles']:8d} {s['broadcasts']:10d} {s['smj']:3d} {s['bhj']:3d} "
              f"{s['sort_agg']:7d} {s['python']:6d} {str(s['pushed']):>6s}")
    spark.stop()


if __name__ == "__main__":
    main()
