"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed end to end into Spark's ``noop`` sink (full
execution, no collect to the driver); the reported time is the best of
$BENCH_REPEATS runs after one untimed warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrine.plans.queries import QUERIES  # noqa: E402
from vitrine.session import build_session  # noqa: E402

HEADLINE = ["funnel", "logistics_sla", "abandoned_carts", "click_checkout_pair_count",
            "arrival_watermark", "sliding_clicks", "closed_windows", "alerts_all",
            "scan_tolerant", "stream_once"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="vitrine-bench",
                          extra={"spark.driver.memory": "8g"})
    run(spark, "funnel", sf_dir)  # warm-up: JVM, codegen caches
    times, errors = {}, {}
    for name in names:
        try:
            times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeats)), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
