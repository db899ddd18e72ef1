"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names, default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "post_deposit_txn post_card_txn post_payment post_loan_txn post_mf_transaction idempotent_dedupe running_balance "
    "silver_nav_clean bronze_parse_payload upsert_replace incremental_new_rows asof_nav floored_running_sum loan_amortization "
    "loan_delinquency mf_holding_snapshot wealth_snapshot dq_constraint_report dq_orphans stream_post_deposit"
).split()


def main() -> None:
    from check import session
    from ledgerlake.plans import catalogue

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    # One small run starts the JVM's code paths and the Python workers.
    catalogue.QUERIES["post_deposit_txn"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
