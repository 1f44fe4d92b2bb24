"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.session import build_session
from daybook.verification.catalogue import QUERIES

HEADLINE = (
    "signing_by_client_month",
    "accumulated_by_locality",
    "order_registration_state",
    "cert_order_two_runs",
    "user_table",
    "turn_order_table",
    "cert_table",
    "credential_two_runs",
    "credential_stored_two_runs",
    "transaction_two_runs",
    "keyed_merge",
    "latest_version_per_key",
    "incremental_window_scan",
    "archive_overlap_scan",
    "archive_manifest",
    "status_history",
    "last_error_log",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="daybook-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the executor and loads the planner's classes.
    QUERIES["equality_scan"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
