"""Run control: append-only event tables whose newest row is the state."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import cron
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.quality import new_schema_versions, pass_rate, quality_status
from wardflow.schemas import TABLES
from wardflow.sources.tables import append_batch, path_exists, read_table, stage

log = logging.getLogger(__name__)

# Weekday names of the old schedule and their cron numbers.
CRON_DAYS = {
    "SUNDAY": 0, "MONDAY": 1, "TUESDAY": 2, "WEDNESDAY": 3, "THURSDAY": 4, "FRIDAY": 5, "SATURDAY": 6,
}
UNREADABLE = "UNREADABLE"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def append_row(spark: SparkSession, name: str, root: str, **values) -> None:
    """Append one row to a control table; the first row creates it."""
    table = TABLES[name]
    row = spark.createDataFrame([tuple(values.get(f.name) for f in table.struct)], table.struct)
    writer = row.coalesce(1).write.mode("append")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(table.path(root))


def start_pipeline_run(
    spark: SparkSession, pipeline_name: str, layer: str, triggered_by: str = "SCHEDULE", root: str = "."
) -> str:
    """Record a RUNNING row; returns the run id."""
    run_id = str(uuid.uuid4())
    now = _now()
    append_row(
        spark, "pipeline_runs", root, run_id=run_id, pipeline_name=pipeline_name, layer=layer,
        triggered_by=triggered_by, status="RUNNING", started_at=now, recorded_at=now,
    )
    return run_id


def complete_pipeline_run(
    spark: SparkSession,
    run_id: str,
    records_read: int,
    records_written: int,
    records_failed: int,
    watermark_to: datetime | None = None,
    error_message: str | None = None,
    root: str = ".",
    layer: str | None = None,
) -> None:
    """Record the end of a run: FAILED with an error message, else SUCCESS.

    A given ``layer`` names the one partition the start row is looked up in.
    """
    runs = read_table(spark, TABLES["pipeline_runs"], root)
    if layer is not None:
        runs = runs.filter(F.col("layer") == layer)
    start = runs.filter((F.col("run_id") == run_id) & (F.col("status") == "RUNNING")).first()
    now = _now()
    began = start.started_at.astimezone(timezone.utc) if start else now
    append_row(
        spark, "pipeline_runs", root, run_id=run_id,
        pipeline_name=start.pipeline_name if start else None,
        layer=start.layer if start else None,
        triggered_by=start.triggered_by if start else None,
        status="FAILED" if error_message else "SUCCESS",
        started_at=began, recorded_at=now,
        duration_seconds=max((now - began).total_seconds(), 0.0),
        records_read=records_read, records_written=records_written, records_failed=records_failed,
        watermark_to=watermark_to, error_message=error_message or None,
    )


def write_job_bookmark(
    spark: SparkSession, job_name: str, source_name: str, record_count: int,
    batch_id: str | None = None, run_status: str = "SUCCESS", root: str = ".",
) -> None:
    """Record a bookmark; a failure to do so is logged, never raised."""
    try:
        append_row(
            spark, "job_bookmark", root, job_name=job_name, source_name=source_name,
            record_count=record_count, batch_id=batch_id or spark.sparkContext.applicationId,
            run_status=run_status, updated_at=_now(),
        )
    except Exception:
        log.warning("bookmark of %s not written", job_name, exc_info=True)


def write_pipeline_log(
    spark: SparkSession, pipeline_name: str, records_processed: int, records_quarantined: int = 0,
    duration_seconds: float = 0.0, status: str = "SUCCESS", error_message: str | None = None, root: str = ".",
) -> None:
    """Record one job execution."""
    append_row(
        spark, "pipeline_log", root, pipeline_id=str(uuid.uuid4()), pipeline_name=pipeline_name,
        event_timestamp=_now(), status=status, records_processed=records_processed,
        records_quarantined=records_quarantined, duration_seconds=float(duration_seconds),
        error_message=error_message[:500] if error_message else None,
    )


def write_dq_results(
    spark: SparkSession, dataset_name: str, total_records: int, valid_records: int, quarantined: int,
    error_summary: dict[str, int], source_file: str, root: str = ".",
) -> None:
    """Record one data-quality summary."""
    counts = spark.createDataFrame(
        [(dataset_name, source_file, _now(), total_records, valid_records, quarantined, error_summary)],
        "dataset_name STRING, source_file STRING, run_timestamp TIMESTAMP, total_records BIGINT,"
        " valid_records BIGINT, quarantined BIGINT, error_summary MAP<STRING,BIGINT>",
    )
    row = counts.withColumns(
        {"pass_rate": pass_rate("valid_records", "total_records"), "quality_status": quality_status()}
    ).select(*TABLES["data_quality_results"].struct.names)
    append_batch(row, TABLES["data_quality_results"].path(root), str(uuid.uuid4()))


def write_schema_registry(spark: SparkSession, dataset_name: str, fieldnames: list[str], root: str = ".") -> None:
    """Register a column set unless this dataset already has it."""
    header = spark.createDataFrame(
        [(dataset_name, fieldnames, _now())], "dataset_name STRING, columns ARRAY<STRING>, seen_at TIMESTAMP"
    )
    table = TABLES["schema_registry"]
    fresh = new_schema_versions(header, read_table(spark, table, root)).select(*table.struct.names)
    append_batch(fresh, table.path(root), str(uuid.uuid4()))


def last_offset(spark: SparkSession, job_name: str, source_name: str, root: str = ".") -> str | None:
    """Position text of the newest successful bookmark, if any."""
    marks = read_table(spark, TABLES["job_bookmark"], root).filter(
        (F.col("job_name") == job_name) & (F.col("source_name") == source_name) & (F.col("run_status") == "SUCCESS")
    )
    return marks.agg(F.max_by("batch_id", "updated_at")).first()[0]


def current_runs(events: DataFrame) -> DataFrame:
    """State of each run: its terminal row if any, else its RUNNING row."""
    finished = F.when(F.col("status") == "RUNNING", 0).otherwise(1)
    return latest_per_key(events, ["run_id"], [finished.desc(), F.col("recorded_at").desc()])


def current_bookmarks(bookmarks: DataFrame) -> DataFrame:
    """Newest bookmark per (job, source)."""
    return latest_per_key(bookmarks, ["job_name", "source_name"], ["updated_at", "batch_id"])


def file_id(checksum: str | Column = "file_checksum") -> Column:
    """Identifier of a registered file, fixed by its content."""
    return F.md5(F.concat(F.lit("file|"), checksum))


def registry_rows(files: DataFrame, recorded_at: Column) -> DataFrame:
    """First registry row of each file: ingested, later layers pending.

    ``files`` carries file_checksum, source_path, bronze_path, hospital_id,
    file_date, record_count, quarantine_count and bronze_run_id.
    """
    pending = F.lit("PENDING")
    never = F.lit(None).cast("timestamp")
    return files.withColumns(
        {
            "file_id": file_id(),
            "bronze_status": F.lit("INGESTED"),
            "silver_status": pending,
            "gold_status": pending,
            "bronze_at": recorded_at,
            "silver_at": never,
            "gold_at": never,
            "run_id": F.col("bronze_run_id"),
            "recorded_at": recorded_at,
        }
    ).select(*TABLES["file_registry"].struct.names)


def append_registry(rows: DataFrame, root: str, batch: str) -> None:
    """Append registry rows under a batch id."""
    append_batch(rows, TABLES["file_registry"].path(root), batch, ("file_date",))


def batches_reached(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Ingestion batches that a layer has taken in completely."""
    rows = read_table(spark, TABLES["processed_batches"], root)
    return rows.filter(F.col("layer") == layer).select("ingest_batch").distinct()


def ingested_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batches whose ledger rows, written last of all, are there."""
    table = TABLES["ingestion_ledger"]
    if not path_exists(spark, table.path(root)):
        return spark.createDataFrame([], "ingest_batch STRING")
    ledger = spark.read.schema("file_checksum STRING, _batch STRING").parquet(table.path(root))
    return ledger.select(F.col("_batch").alias("ingest_batch")).distinct()


def mark_batches(spark: SparkSession, root: str, layer: str, batches: list[str], run_id: str) -> None:
    """Record that a layer holds all rows of ``batches``; the last step of a run."""
    rows = spark.createDataFrame([(layer, b, run_id, _now()) for b in batches], TABLES["processed_batches"].struct)
    append_batch(rows, TABLES["processed_batches"].path(root), f"{run_id}-{layer}")


def register_file(
    spark: SparkSession, file_checksum: str, source_path: str, bronze_path: str, hospital_id: str,
    file_date, record_count: int, quarantine_count: int, bronze_run_id: str, root: str = ".",
) -> str:
    """Register a file once; registering it again changes nothing. Returns
    its file id."""
    registry = read_table(spark, TABLES["file_registry"], root)
    known = registry.filter(F.col("file_checksum") == file_checksum).select("file_id").first()
    if known:
        return known.file_id
    ddl = (
        "file_checksum STRING, source_path STRING, bronze_path STRING, hospital_id STRING, file_date DATE,"
        " record_count BIGINT, quarantine_count BIGINT, bronze_run_id STRING"
    )
    row = spark.createDataFrame(
        [(file_checksum, source_path, bronze_path, hospital_id, file_date, record_count, quarantine_count,
          bronze_run_id)],
        ddl,
    )
    rows = registry_rows(row, F.lit(_now()).cast("timestamp"))
    append_registry(rows, root, str(uuid.uuid4()))
    return rows.select("file_id").first()[0]


def current_files(registry: DataFrame) -> DataFrame:
    """Newest row per file."""
    return latest_per_key(registry, ["file_checksum"], ["recorded_at", "run_id"])


def layer_status_rows(files: DataFrame, layer: str, status: str, run_id: str, at: Column) -> DataFrame:
    """Registry rows that move ``files`` to a layer status."""
    return files.withColumns(
        {
            f"{layer}_status": F.lit(status),
            f"{layer}_at": at,
            "run_id": F.lit(run_id),
            "recorded_at": at,
        }
    ).select(*TABLES["file_registry"].struct.names)


def update_file_layer_status(
    spark: SparkSession, file_checksum: str, layer: str, status: str, run_id: str, root: str = "."
) -> None:
    """Append the new state of one file."""
    registry = read_table(spark, TABLES["file_registry"], root)
    file = current_files(registry.filter(F.col("file_checksum") == file_checksum))
    rows = layer_status_rows(file, layer, status, run_id, F.lit(_now()).cast("timestamp"))
    append_registry(rows, root, str(uuid.uuid4()))


def files_reaching_layer(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Registered files with at least one row in a layer, found in bulk."""
    sources = rows.select(F.col("_source_file").alias("source_path")).distinct()
    return current_files(registry).join(sources, "source_path", "left_semi")


def schedule_cron(day: str = "expected_day", hour: str = "expected_by_hour") -> Column:
    """Cron text from a weekday name (or DAILY) and an hour."""
    number = F.coalesce(
        *[F.when(F.upper(F.trim(F.col(day))) == name, F.lit(str(n))) for name, n in CRON_DAYS.items()], F.lit("*")
    )
    return F.concat(F.lit("0 "), F.col(hour).cast("string"), F.lit(" * * "), number)


def migrate_file_schedule(old: DataFrame) -> DataFrame:
    """New-form schedule rows; a frame already in the new form is unchanged."""
    if "facility_id" in old.columns and "schedule_cron" in old.columns:
        return old
    return old.select(
        F.col("hospital_id").alias("facility_id"),
        F.lit("STAFFING").alias("file_type"),
        schedule_cron().alias("schedule_cron"),
        (F.col("grace_period_hrs") * 60).cast("int").alias("grace_period_minutes"),
        F.lit("WARN").alias("alert_severity"),
        "is_active",
        "last_received_at",
        "consecutive_misses",
    )


def missed_files(schedule: DataFrame, arrivals: DataFrame, as_of: str, since: str) -> DataFrame:
    """Active schedules with their count of expected slots missed in a row.

    A slot counts when it lies after the last arrival and its grace period
    ended before ``as_of``. Sources that never arrived count from ``since``. A
    schedule whose cron expression cannot be read has no count and the severity
    ``UNREADABLE``.
    """
    newest = arrivals.groupBy("facility_id", "file_type").agg(F.max("received_at").alias("_arrived"))
    last = F.unix_timestamp(F.coalesce("last_received_at", F.lit(since).cast("timestamp")))
    limit = F.ceil(F.unix_micros(F.lit(as_of).cast("timestamp")) / 1_000_000) - F.col("grace_period_minutes") * 60
    misses = F.col("consecutive_misses")
    active = schedule.filter("is_active").join(newest, ["facility_id", "file_type"], "left")
    dated = active.withColumn("last_received_at", F.greatest("last_received_at", "_arrived"))
    spans = dated.select(F.col("schedule_cron").alias("line"), cron.day_of(last).alias("first"), cron.day_of(limit).alias("last"))
    # Written, as sources share few lines: Spark then sends the lines to the sources.
    lines = stage(schedule.sparkSession, cron.calendars(spans), "calendars")
    named = lines.select(*[F.col(c).alias(f"_{c}") for c in lines.columns])
    days = cron.days_between(F.col("_base"), F.col("_upto"), last, limit)
    return (
        dated.join(named, F.col("schedule_cron") == F.col("_line"), "left")
        .withColumn("consecutive_misses", cron.slots_between(F.col("_cron"), last, limit, days).cast("int"))
        .withColumn("severity", F.when(misses.isNull(), UNREADABLE).when(misses > 0, F.col("alert_severity")))
        .drop("_arrived", *named.columns)
    )


def seed_schedule(facilities: DataFrame) -> DataFrame:
    """One schedule row per facility and file type."""
    # Our choice: cron, grace minutes and severity per file type.
    kinds = F.array(
        *[
            F.struct(
                F.lit(kind).alias("file_type"),
                F.lit(cron).alias("schedule_cron"),
                F.lit(grace).alias("grace_period_minutes"),
                F.lit(severity).alias("alert_severity"),
            )
            for kind, cron, grace, severity in [
                ("STAFFING", "0 8 * * *", 60, "CRITICAL"),
                ("SCHEDULE_DELTA", "0 12 * * *", 120, "WARN"),
                ("CALLOUT", "0 6 * * *", 30, "INFO"),
            ]
        ]
    )
    return facilities.select("facility_id", F.inline(kinds)).select(
        "*",
        F.lit(True).alias("is_active"),
        F.lit(None).cast("timestamp").alias("last_received_at"),
        F.lit(0).alias("consecutive_misses"),
    )
