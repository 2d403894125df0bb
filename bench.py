"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the input, BENCH_CPUS (default 8) the cores.
Every query runs over its whole tables; its full result is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTERED  # noqa: E402
from starmart.session import local_session  # noqa: E402

HEADLINE = [
    "monthly_aggregate",
    "fact_initial",
    "fact_resolved",
    "fact_rejects",
    "fact_resolved_as_of",
    "asof_closed",
    "scd2_apply",
    "scd1_upsert_account",
    "fact_insert_if_absent",
    "fact_upsert",
    "apply_changes",
    "dim_deal_stage",
    "aggregate_by_product",
    "source_checks",
    "initial_load",
    "incremental_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "starmart-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("monthly_aggregate")  # not counted: starts the threads and warms the code generator
    # Whole loads write tables and run once; of the others the median of three runs counts.
    times = {name: median(run(name) for _ in range(1 if name.endswith("_load") else 3)) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
