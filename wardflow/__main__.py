"""Ask the control tables: ``python -m wardflow --root LAKE --query NAME``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from wardflow.config import build_session
from wardflow.operators import ops, quality
from wardflow.plans.jobs import read_quarantine
from wardflow.schemas import TABLES
from wardflow.sources.landing import file_manifest, literal_path
from wardflow.sources.tables import read_snapshot, read_table

NAMES = [
    "all", "alerts", "dq_trend", "duplicate_check", "files_with_quarantine", "job_status", "missed_files", "pipeline_failures",
    "pipeline_runs", "quarantine_by_file", "quarantine_by_rule", "quarantine_of_facility", "quarantine_unresolved",
    "schema_changes", "schema_drift",
]


def checksum_of(spark: SparkSession, path: str) -> str:
    """The checksum that ingestion stores for a file; not the file's plain MD5."""
    return file_manifest(spark, literal_path(path)).first().file_checksum


def ask(spark: SparkSession, root: str, query: str, **given) -> DataFrame:
    """The answer to one named question. ``given`` may hold as_of and since (time
    text), days, dataset, file, checksum and facility. ``duplicate_check`` takes
    a stored checksum, or a file whose checksum it computes."""

    def table(name: str) -> DataFrame:
        return read_table(spark, TABLES[name], root)

    as_of = given.get("as_of") or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    days = int(given.get("days") or 7)
    answers = {
        "all": lambda: ops.health_check(
            table("ingestion_ledger"), read_quarantine(spark, root), table("data_quality_results"),
            table("schema_registry"), table("job_bookmark"), table("pipeline_log"), as_of,
        ),
        "alerts": lambda: ops.alerts(
            table("data_quality_results"), table("job_bookmark"), read_quarantine(spark, root), as_of,
            table("schema_registry"), given.get("since"),
        ),
        "dq_trend": lambda: ops.dq_trend(
            table("data_quality_results"), given.get("dataset") or "sftp_staffing", as_of[:10], days
        ),
        "duplicate_check": lambda: ops.duplicate_check(
            table("ingestion_ledger"), given.get("checksum") or checksum_of(spark, given["file"])
        ),
        "files_with_quarantine": lambda: ops.files_with_quarantine(read_quarantine(spark, root)),
        "job_status": lambda: ops.job_status(table("pipeline_log"), as_of[:10]),
        "missed_files": lambda: read_snapshot(spark, TABLES["file_schedule"], root).filter("consecutive_misses > 0 or is_active and consecutive_misses is null"),
        "pipeline_failures": lambda: ops.pipeline_failures(table("pipeline_log"), as_of, days),
        "pipeline_runs": lambda: ops.pipeline_runs(table("pipeline_runs"), as_of, days),
        "quarantine_by_file": lambda: ops.quarantine_by_file(read_quarantine(spark, root), given["file"]),
        "quarantine_by_rule": lambda: ops.quarantine_by_rule(read_quarantine(spark, root)),
        "quarantine_of_facility": lambda: ops.quarantine_of_facility(
            read_quarantine(spark, root), given["facility"], as_of[:10]
        ),
        "quarantine_unresolved": lambda: ops.quarantine_unresolved(read_quarantine(spark, root)),
        "schema_changes": lambda: quality.schema_changes(table("schema_registry")),
        "schema_drift": lambda: ops.schema_drift(table("schema_registry")),
    }
    return answers[query]()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder the tables lie in")
    parser.add_argument("--query", required=True, choices=NAMES)
    for option in ("as-of", "days", "dataset", "facility"):
        parser.add_argument(f"--{option}")
    parser.add_argument("--since", help="alerts: when they were last looked for; older schema versions are left out")
    parser.add_argument("--file", help="file to look for; duplicate_check reads it and computes the stored checksum")
    parser.add_argument("--checksum", help="checksum as the ledger has it, which is not the file's plain MD5")
    parser.add_argument("--limit", type=int, help="print only so many rows; by default all are printed")
    parser.add_argument("--out", help="write the answer to this folder as JSON lines instead of printing it")
    given = vars(parser.parse_args())
    limit, out = given.pop("limit"), given.pop("out")
    spark = build_session("wardflow-ask")
    answer = ask(spark, given.pop("root"), given.pop("query"), **given)
    if limit is not None:
        answer = answer.limit(limit)
    if out:
        answer.write.json(out)
        return
    for row in answer.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str))


if __name__ == "__main__":
    main()
