"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows are
collected to the driver).  One warm-up pass, then the median of
$BENCH_REPEAT timed runs per query.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from claimlake.plans.catalog import QUERIES  # noqa: E402
from claimlake.session import local_session  # noqa: E402

HEADLINE = [
    "claims_silver", "exposure_dq_split", "payments_dq", "expenses_silver",
    "claim_snapshot", "policy_performance", "portfolio_performance", "gold_violations",
    "ibnr_bf", "ibnr_adjusted_result", "scd2_history", "policy_as_of",
]


def run(spark, name, root):
    t0 = time.perf_counter()
    QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, app="claimlake-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    timings = {}
    for name in names:
        run(spark, name, root)  # warm-up: JIT, codegen cache, file listing
        timings[name] = round(statistics.median(run(spark, name, root) for _ in range(repeat)), 3)
    sf = os.path.basename(root.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
