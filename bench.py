"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median of the runs is reported per query),
BENCH_QUERIES (comma list to restrict).

Each run builds the query from scratch and executes it fully with the
``noop`` sink (every row computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "loan_profit_estimates",
    "clean_accounts",
    "clean_balances",
    "clean_transactions",
    "detect_changes",
    "merge_upsert",
    "identity_initial",
    "dim_date",
    "dim_account",
    "fact_balance",
    "fact_transaction",
    "fact_balance_joined",
    "dim_account_scd2",
    "mart_balance_by_month",
    "mart_transactions_by_type",
    "profile_accounts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lendstar.plans.queries import QUERIES
    from lendstar.session import build_session

    spark = build_session(f"local[{cpus}]", app="lendstar-bench", shuffle_partitions=cpus)
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
