"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every
query is evaluated in full (all columns, no sink) twice; the faster run
counts, so that compiling the generated code is not part of the figure.
"""

from __future__ import annotations

import json
import os
import re
import time

from wardflow.config import build_session
from wardflow.plans.queries import QUERIES

HEADLINE = [
    "work_dates",
    "silver_casts",
    "validation_reasons",
    "split_valid",
    "dq_summary",
    "quarantine_index",
    "quarantine_by_rule",
    "silver_staffing",
    "silver_shifts",
    "fact_staffing",
    "fact_overtime",
    "merge_fact_staffing",
    "overtime_features",
    "standard_events",
    "hourly_census",
    "replay_census",
    "running_census",
    "dim_after_changes",
    "file_layer_status",
    "missed_files",
    "schema_drift",
    "facility_daily_summary",
    "np_ratio_realtime",
    "ot_summary_monthly",
    "scorecard_quarterly",
    "health_check",
    "alerts",
    "ingest_bronze",
    "event_silver_stream",
    "replay_safe_stream",
    "upsert_census",
    "upsert_fact_staffing",
    "late_batch_silver",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wardflow-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.files.openCostInBytes": "262144",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    times = {name: min(run(name), run(name)) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
