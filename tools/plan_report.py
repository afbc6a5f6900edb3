"""Summarise the physical plan of every registered query (PLANS.md).

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange) by kind, broadcasts, window / sort-aggregate
nodes, Python nodes, whole-stage codegen spans, and the columns each parquet
scan reads.  Streaming and sink queries are planned over what they read back.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.plans.queries import QUERIES  # noqa: E402
from vitrine.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    scans = re.findall(r"FileScan (\w+) \[([^\]\n]*)\][^\n]*?PushedFilters: \[([^\]\n]*?)(?:\]|\.\.\.)", plan)
    return {
        "shuffles": {k: exchanges.count(k) for k in sorted(set(exchanges))},
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "sort_aggs": plan.count("SortAggregate"),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "scans": [(fmt, cols.count(",") + 1 if cols else 0, pushed or "-") for fmt, cols, pushed in scans],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, app_name="vitrine-plans")
    print(f"# Physical plans at `{sf_dir}` (generated by `tools/plan_report.py`)\n")
    print("Shuffles are Exchange nodes by partitioning; `scans` = (format, columns read, pushed filters).")
    print("Plans are the final adaptive plans after running each query once (AQE's runtime choices included).")
    print("`sort-aggs` are `max_by` steps over already-aggregated rows or a global (key-less) aggregate.\n")
    print("| query | shuffles | broadcasts | windows | group-limits | sort-aggs | python | codegen stages | scans |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()                      # run it, so AQE shows its final plan
        plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarise(plan)
        shuffles = ", ".join(f"{k}×{v}" for k, v in s["shuffles"].items()) or "none"
        scans = "; ".join(f"{f} {c} cols, pushed {p}" for f, c, p in s["scans"]) or "-"
        print(f"| `{name}` | {shuffles} | {s['broadcasts']} | {s['windows']} | {s['group_limits']} | "
              f"{s['sort_aggs']} | {s['python']} | {s['codegen_stages']} | {scans} |")


if __name__ == "__main__":
    main()
