"""Operator questions over the control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.config import PASS_RATE_WARN
from wardflow.operators.control import current_bookmarks, current_runs
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.quality import pass_rate, schema_changes, schema_drift
from wardflow.sources.tables import stage


def quarantine_unresolved(index: DataFrame) -> DataFrame:
    return index.filter(~F.col("resolved"))


def quarantine_by_rule(index: DataFrame) -> DataFrame:
    """Records per broken rule."""
    return (
        index.select(F.explode("quarantine_reason").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def quarantine_by_file(index: DataFrame, source_file: str) -> DataFrame:
    return index.filter(F.col("source_file") == source_file)


def files_with_quarantine(index: DataFrame) -> DataFrame:
    """Files with bad records, and how many are still open."""
    return index.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(~F.col("resolved")).alias("unresolved")
    )


def quarantine_of_facility(index: DataFrame, facility_id: str, week_ending: str) -> DataFrame:
    """Bad records of one facility in the seven days up to a date."""
    day = F.to_date("ingestion_timestamp")
    end = F.lit(week_ending).cast("date")
    return index.filter(
        (F.col("facility_id") == facility_id) & (day > F.date_sub(end, 7)) & (day <= end)
    )


def dq_trend(results: DataFrame, dataset: str, as_of: str, days: int) -> DataFrame:
    """Daily totals and pass rate of one dataset over the last days."""
    day = F.to_date("run_timestamp")
    end = F.lit(as_of).cast("date")
    return (
        results.filter((F.col("dataset_name") == dataset) & (day > F.date_sub(end, days)) & (day <= end))
        .groupBy(day.alias("run_date"))
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("valid_records").alias("valid_records"),
            F.sum("quarantined").alias("quarantined"),
        )
        .withColumn("pass_rate", pass_rate())
    )


def job_status(log: DataFrame, day: str) -> DataFrame:
    """Last execution of each pipeline on a day."""
    today = log.filter(F.to_date("event_timestamp") == F.lit(day).cast("date"))
    return latest_per_key(today, ["pipeline_name"], ["event_timestamp", "pipeline_id"])


def _within(column: str, as_of: str, days: int):
    end = F.lit(as_of).cast("timestamp")
    return (F.col(column) > end - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(column) <= end)


def pipeline_failures(log: DataFrame, as_of: str, days: int) -> DataFrame:
    """Failed executions of the last days."""
    return log.filter((F.col("status") == "FAILED") & _within("event_timestamp", as_of, days))


def pipeline_runs(events: DataFrame, as_of: str, days: int) -> DataFrame:
    """Runs started in the last days, in their current state."""
    return current_runs(events.filter(_within("started_at", as_of, days)))


def duplicate_check(ledger: DataFrame, checksum: str) -> DataFrame:
    """The ledger entry of a checksum, if the file was processed before."""
    return ledger.filter(F.col("file_checksum") == checksum)


def health_check(
    ledger: DataFrame, index: DataFrame, results: DataFrame, registry: DataFrame,
    bookmarks: DataFrame, log: DataFrame, as_of: str,
) -> DataFrame:
    """(check_name, value) over all six control tables, one pass over each."""

    def checks(df: DataFrame, **values) -> DataFrame:
        row = df.agg(*[value.cast("bigint").alias(name) for name, value in values.items()])
        cells = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("value")) for name in values]
        return row.select(F.inline(F.array(*cells)))

    n = F.count(F.lit(1))
    failed_today = (F.col("status") == "FAILED") & (F.to_date("event_timestamp") == F.lit(as_of).cast("date"))
    parts = [
        checks(ledger, files_ingested=n),
        checks(index, quarantine_records=n, quarantine_unresolved=F.count_if(~F.col("resolved"))),
        checks(results, dq_runs=n, dq_fail_runs=F.count_if(F.col("quality_status") == "FAIL")),
        checks(schema_drift(registry), datasets_with_drift=n),
        checks(current_bookmarks(bookmarks), bookmarks=n),
        checks(log, runs_failed_today=F.count_if(failed_today)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def alerts(
    results: DataFrame,
    bookmarks: DataFrame,
    index: DataFrame,
    as_of: str,
    registry: DataFrame | None = None,
    since: str | None = None,
) -> DataFrame:
    """(alert, subject, severity) rows for the data-side conditions: a pass
    rate below 90, a bookmark not moved on the day by 08:00, an unresolved
    quarantine record older than 30 minutes, and, with the schema registry, a
    version that adds or lacks columns. A version alerts once: those first seen
    at ``since``, when alerts were last looked for, or before are left out."""
    now = F.lit(as_of).cast("timestamp")
    low = results.filter(F.col("pass_rate") < PASS_RATE_WARN).select(
        F.lit("DQ_PASS_RATE").alias("alert"), F.col("source_file").alias("subject"), F.lit("FAIL").alias("severity")
    )
    due = F.date_trunc("day", now)
    stale = (
        current_bookmarks(bookmarks)
        .filter((F.col("updated_at") < due) & (F.hour(now) >= 8))
        .select(
            F.lit("BOOKMARK_STALE").alias("alert"),
            F.concat_ws("/", "job_name", "source_name").alias("subject"),
            F.lit("WARN").alias("severity"),
        )
    )
    waiting = (
        quarantine_unresolved(index)
        .groupBy("source_file")
        .agg(F.min("ingestion_timestamp").alias("oldest"))
        .filter(F.col("oldest") < now - F.expr("INTERVAL 30 MINUTES"))
        .select(
            F.lit("QUARANTINE_AGE").alias("alert"),
            F.col("source_file").alias("subject"),
            F.lit("WARN").alias("severity"),
        )
    )
    found = low.unionByName(stale).unionByName(waiting)
    if registry is None:
        return found
    changes = schema_changes(registry).filter((F.size("added") > 0) | (F.size("missing") > 0))
    if since is not None:
        changes = changes.filter(F.col("seen_at") > F.lit(since).cast("timestamp"))
    drifted = changes.select(
        F.lit("SCHEMA_DRIFT").alias("alert"), F.concat_ws("/", "dataset_name", "version").alias("subject"), F.lit("WARN").alias("severity")
    )
    return found.unionByName(drifted)


def with_places(spark: SparkSession, df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` in the order of ``columns``, with each row's ``place`` from 0.

    Sorting is by ranges, and a row's place is its place in its range after the
    rows of all ranges before: only the ranges' sizes meet in one task.
    """
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")
    ranged = stage(spark, df.orderBy(*columns).select("*", F.spark_partition_id().alias("_range"), at), "ordered")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    return ranged.join(starts, "_range").withColumn("place", F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")


def within_retention(df: DataFrame, date_column: str, as_of: str, days: int) -> DataFrame:
    """Rows a layer still keeps; on a partition column whole folders drop out."""
    return df.filter(F.col(date_column) >= F.date_sub(F.lit(as_of).cast("date"), days))
