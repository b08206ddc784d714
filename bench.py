"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from eventloom.plans import all_queries
from eventloom.session import local_session

HEADLINE = (
    "user_enrichment",
    "lookup_join",
    "stream_stream_join",
    "user_activity_hourly",
    "user_activity_sliding",
    "user_sessions",
    "user_analytics_daily",
    "session_gap_window",
    "user_anomaly_detection",
    "user_anomaly_detection_dense",
    "chk_enrichment_completeness",
    "chk_hourly",
    "smt_rename",
    "smt_cast",
    "smt_extract",
    "smt_insert_ts",
    "smt_chain",
    "validate_json_schema",
    "validate_csv",
    "validate_xml",
    "alert_error_rate",
    "alert_throughput_drop",
    "result_trends",
    "flaky_tests",
    "flow_integrity",
    "flow_ordering",
    "gate_evaluate",
)

# These transform customer records; everything else reads the events.
CUSTOMER_QUERIES = {"smt_rename", "smt_cast", "smt_extract", "smt_chain"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "8g"), name="bench")
    queries = all_queries()
    events, customers = (
        spark.read.parquet(f"{sf_dir}/{table}.parquet").count() for table in ("events", "customer")
    )
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        best = None
        for _run in range(2):  # the first run pays for class loading and code generation
            started = time.perf_counter()
            frame = queries[name](spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
        rows[name] = round((customers if name in CUSTOMER_QUERIES else events) / best)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows_per_second": rows,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
