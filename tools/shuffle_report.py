"""Bytes and rows read vs shuffled per registered query, from Spark's event log.

    python tools/shuffle_report.py [sf_dir] [query ...] > SHUFFLE.md

Each query runs once into the ``noop`` sink under its own job group; the
event log (written below the scratch folder, no UI or server involved) is then
summed per group: input bytes / records read, shuffle bytes / records written,
and the largest single task's shuffle-read records (a skew indicator).
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.plans.queries import QUERIES  # noqa: E402
from vitrine.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.1"
    names = [a for a in args if "/" not in a] or list(QUERIES)
    log_dir = os.path.join(os.environ.get("SHUFFLE_LOG_DIR", "/tmp"), f"vitrine-eventlog-{os.getpid()}")
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session("local[8]", 8, app_name="vitrine-shuffle",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for name in names:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    app_id = sc.applicationId
    spark.stop()

    stage_group, totals = {}, {}
    for path in glob.glob(os.path.join(log_dir, f"*{app_id}*")):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    t = totals.setdefault(group, {"in_bytes": 0, "in_rows": 0, "sh_bytes": 0,
                                                  "sh_rows": 0, "max_task_read": 0})
                    t["in_bytes"] += m.get("Input Metrics", {}).get("Bytes Read", 0)
                    t["in_rows"] += m.get("Input Metrics", {}).get("Records Read", 0)
                    w = m.get("Shuffle Write Metrics", {})
                    t["sh_bytes"] += w.get("Shuffle Bytes Written", 0)
                    t["sh_rows"] += w.get("Shuffle Records Written", 0)
                    r = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    t["max_task_read"] = max(t["max_task_read"], r)
    print(f"# Read vs shuffled per query at `{sf_dir}` (from the event log; `tools/shuffle_report.py`)\n")
    print("Includes every job a query runs (sampling, writes of sinks and snapshots).  At this size AQE")
    print("coalesces ordinary shuffles toward 64 MB partitions, so one task may read a whole small shuffle;")
    print("that is packing, not skew.  The watermark's row exchange is the one with an explicit partition count.")
    print("Streaming micro-batches run on the streams' own threads and are not attributed to the `stream_*` rows.\n")
    print("| query | input rows | input MB | shuffled rows | shuffled MB | max rows read by one task |")
    print("|---|---|---|---|---|---|")
    for name in names:
        t = totals.get(name, {})
        print(f"| `{name}` | {t.get('in_rows', 0):,} | {t.get('in_bytes', 0) / 1e6:.2f} | "
              f"{t.get('sh_rows', 0):,} | {t.get('sh_bytes', 0) / 1e6:.2f} | {t.get('max_task_read', 0):,} |")


if __name__ == "__main__":
    main()
