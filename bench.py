"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is built and fully executed into Spark's no-op sink (no driver
collect). After one warm-up round of the whole set (JIT, codegen caches),
every query runs 3 more times; the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "transfer_pipeline",
    "throttle",
    "balance_per_request",
    "balance_rule_split",
    "balance_per_account",
    "last_request",
    "ledger_in_sync",
    "balance_sum",
    "volume_union",
    "ledger_latest_n",
    "read_keyed_transfers",
    "cdc_current_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tollgate.session import build_session
    from tollgate.plans import catalog
    from tollgate.sources import events as EV

    spark = build_session(f"local[{cpus}]", max(2, cpus), app="tollgate-bench")
    qs = catalog.queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up (JIT, file listing caches)
        run(name)
    runs = {name: [] for name in HEADLINE}
    for _ in range(3):
        for name in HEADLINE:
            runs[name].append(run(name))
    times = {name: round(sorted(v)[1], 3) for name, v in runs.items()}
    n_requests = EV.requests(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "pipeline_requests_per_sec": round(n_requests / times["transfer_pipeline"], 1),
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
