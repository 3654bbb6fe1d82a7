"""Table definitions: schema, key and partitioning of every stored table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from wardflow.config import STAFFING_COLUMNS


#: Folder column of tables that are stored by month: year * 100 + month.
MONTH = "month_key"


@dataclass(frozen=True)
class Table:
    """A stored table: ``ddl`` lists its columns, partition columns included.

    With ``day`` the folders are the months of that column, which every key
    contains, and files hold whole days in order: a commit moves tens of
    folders however many days it touches, and the days are skipped inside by
    the files' own statistics. The folder column is not one of the table's.
    """

    schema_name: str
    name: str
    ddl: str
    keys: list[str]
    partition_by: list[str] = field(default_factory=list)
    day: str | None = None

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def folders(self) -> list[str]:
        return [MONTH] if self.day else self.partition_by

    @property
    def stored_ddl(self) -> str:
        return f"{self.ddl}, {MONTH} INT" if self.day else self.ddl

    def month(self) -> Column:
        """The folder of a row: of a date, or of a day written yyyymmdd."""
        day = F.col(self.day)
        if isinstance(self.struct[self.day].dataType, DateType):
            return (F.year(day) * 100 + F.month(day)).cast("int")
        return F.expr(f"cast({self.day} div 100 as int)")

    @property
    def full_name(self) -> str:
        return f"{self.schema_name}.{self.name}"

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.schema_name}/{self.name}"


_SILVER_MEASURES = """
    staffing_id STRING, facility_id STRING, work_date DATE, role_code STRING,
    staff_count INT, patient_census INT, hours_worked DOUBLE, hours_overtime DOUBLE,
    shift_type STRING, nurse_patient_ratio DOUBLE, overtime_pct DOUBLE,
    _dq_flags ARRAY<STRING>, _source_file STRING, _ingested_at TIMESTAMP, _record_index STRING
"""

TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table(
            "bronze",
            "stg_staffing",
            ", ".join(f"{c} STRING" for c in STAFFING_COLUMNS)
            + ", _source_file STRING, _ingested_at TIMESTAMP, _record_index STRING,"
            + " _ingest_date DATE, _ingest_batch STRING",
            ["_record_index"],
            ["_ingest_date", "_ingest_batch"],
        ),
        Table(
            "bronze",
            "adt_events_raw",
            "event_type STRING, facility_id STRING, unit_id STRING, patient_id STRING,"
            " event_timestamp STRING, bed_id STRING, attending_role STRING,"
            " _kinesis_partition STRING, _kinesis_sequence STRING, _kinesis_timestamp TIMESTAMP,"
            " _processed_at TIMESTAMP",
            ["_kinesis_partition", "_kinesis_sequence"],
        ),
        Table("silver", "staffing_standardized", _SILVER_MEASURES, ["staffing_id"], day="work_date"),
        Table("silver", "staffing_shifts", _SILVER_MEASURES + ", shift_id STRING", ["shift_id"], day="work_date"),
        Table(
            "silver",
            "adt_events_standardized",
            "event_type STRING, facility_id STRING, unit_id STRING, patient_id STRING,"
            " event_timestamp STRING, bed_id STRING, attending_role STRING,"
            " _kinesis_partition STRING, _kinesis_sequence STRING, _kinesis_timestamp TIMESTAMP,"
            " _processed_at TIMESTAMP, event_ts TIMESTAMP, event_date DATE, event_hour INT,"
            " event_type_std STRING, event_id STRING, census_delta INT",
            ["event_id"],
            ["event_date"],
        ),
        Table(
            "gold",
            "fact_staffing",
            "date_key INT, facility_id STRING, role_code STRING, work_date DATE, staff_count INT,"
            " patient_census INT, hours_worked DOUBLE, hours_overtime DOUBLE, nurse_patient_ratio DOUBLE,"
            " overtime_pct DOUBLE, is_understaffed BOOLEAN, dq_flag_count INT",
            ["date_key", "facility_id", "role_code"],
            day="date_key",
        ),
        Table(
            "gold",
            "fact_overtime",
            "date_key INT, facility_id STRING, role_code STRING, shift_type STRING, work_date DATE,"
            " hours_worked DOUBLE, hours_overtime DOUBLE, overtime_pct DOUBLE, overtime_cost_est DOUBLE",
            ["date_key", "facility_id", "role_code", "shift_type"],
            day="date_key",
        ),
        Table(
            "gold",
            "fact_census_realtime",
            "facility_id STRING, unit_id STRING, event_date DATE, event_hour INT, census BIGINT,"
            " admits BIGINT, discharges BIGINT, transfers BIGINT",
            ["facility_id", "unit_id", "event_date", "event_hour"],
            ["event_date"],
        ),
        Table(
            "gold",
            "census_balance",
            "facility_id STRING, unit_id STRING, event_date DATE, balance BIGINT",
            ["facility_id", "unit_id", "event_date"],
            day="event_date",
        ),
        Table(
            "gold",
            "dim_facility",
            "facility_key BIGINT, facility_id STRING, bed_capacity INT, staffing_benchmark DOUBLE,"
            " is_current BOOLEAN, effective_from DATE, effective_to DATE",
            ["facility_key"],
        ),
        Table(
            "ml_ready",
            "overtime_features",
            "date_key INT, facility_id STRING, role_code STRING, staff_count INT, patient_census INT,"
            " hours_overtime DOUBLE, nurse_patient_ratio DOUBLE, overtime_pct DOUBLE, is_understaffed INT,"
            " avg_census_7d DOUBLE, avg_staff_7d DOUBLE, avg_ot_pct_7d DOUBLE, total_ot_hours_7d DOUBLE,"
            " census_vs_avg DOUBLE, is_weekend BOOLEAN, overtime_pct_lag1 DOUBLE,"
            " will_overtime_next_day BOOLEAN, will_overtime_next_calendar_day BOOLEAN",
            ["date_key", "facility_id", "role_code"],
            day="date_key",
        ),
        Table(
            "batch_control",
            "file_registry",
            "file_checksum STRING, file_id STRING, source_path STRING, bronze_path STRING,"
            " hospital_id STRING, record_count BIGINT, quarantine_count BIGINT, bronze_run_id STRING,"
            " bronze_status STRING, silver_status STRING, gold_status STRING,"
            " bronze_at TIMESTAMP, silver_at TIMESTAMP, gold_at TIMESTAMP,"
            " run_id STRING, recorded_at TIMESTAMP, file_date DATE",
            ["file_checksum"],
            ["file_date"],
        ),
        Table(
            "batch_control",
            "pipeline_runs",
            "run_id STRING, pipeline_name STRING, triggered_by STRING, status STRING,"
            " started_at TIMESTAMP, recorded_at TIMESTAMP, duration_seconds DOUBLE,"
            " records_read BIGINT, records_written BIGINT, records_failed BIGINT, watermark_to TIMESTAMP,"
            " error_message STRING, layer STRING",
            ["run_id"],
            ["layer"],
        ),
        Table(
            "batch_control",
            "scd2_audit",
            "facility_id STRING, changed_on DATE, old_values MAP<STRING,STRING>, new_values MAP<STRING,STRING>",
            ["facility_id", "changed_on"],
        ),
        Table(
            "batch_control",
            "file_schedule",
            "facility_id STRING, file_type STRING, schedule_cron STRING, grace_period_minutes INT,"
            " alert_severity STRING, is_active BOOLEAN, last_received_at TIMESTAMP, consecutive_misses INT",
            ["facility_id", "file_type"],
        ),
        Table(
            "batch_control",
            "ingestion_ledger",
            "file_checksum STRING, source_path STRING, bronze_path STRING, record_count BIGINT,"
            " quarantine_count BIGINT, recorded_at TIMESTAMP",
            ["file_checksum"],
        ),
        Table(
            "batch_control",
            "processed_batches",
            "layer STRING, ingest_batch STRING, run_id STRING, recorded_at TIMESTAMP",
            ["layer", "ingest_batch"],
        ),
        Table(
            "batch_control",
            "quarantine_index",
            "source_file STRING, ingestion_timestamp TIMESTAMP, quarantine_reason ARRAY<STRING>,"
            " facility_id STRING, raw_record STRING, record_hash STRING, resolved BOOLEAN",
            ["source_file", "ingestion_timestamp", "record_hash"],
        ),
        Table(
            "batch_control",
            "data_quality_results",
            "dataset_name STRING, source_file STRING, run_timestamp TIMESTAMP, total_records BIGINT,"
            " valid_records BIGINT, quarantined BIGINT, pass_rate DOUBLE, quality_status STRING,"
            " error_summary MAP<STRING,BIGINT>",
            ["dataset_name", "run_timestamp"],
        ),
        Table(
            "batch_control",
            "schema_registry",
            "dataset_name STRING, schema_version STRING, columns ARRAY<STRING>, registered_at TIMESTAMP",
            ["dataset_name", "schema_version"],
        ),
        Table(
            "batch_control",
            "job_bookmark",
            "job_name STRING, source_name STRING, record_count BIGINT, batch_id STRING,"
            " run_status STRING, updated_at TIMESTAMP",
            ["job_name", "source_name"],
        ),
        Table(
            "batch_control",
            "pipeline_log",
            "pipeline_id STRING, pipeline_name STRING, event_timestamp TIMESTAMP, status STRING,"
            " records_processed BIGINT, records_quarantined BIGINT, duration_seconds DOUBLE,"
            " error_message STRING",
            ["pipeline_id", "event_timestamp"],
        ),
    ]
}

SCHEMA_NAMES = ["bronze", "silver", "gold", "ml_ready", "batch_control"]


def create_all_tables(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Create every schema and table if absent; safe to run again.

    ``prefix`` is put before the schema names so several environments can
    share one catalog. Returns the qualified table names.
    """
    for schema in SCHEMA_NAMES:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{schema}")
    names = []
    for table in TABLES.values():
        name = f"{prefix}{table.full_name}"
        partitioned = f"PARTITIONED BY ({', '.join(table.folders)})" if table.folders else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({table.stored_ddl}) USING parquet"
            f" {partitioned} LOCATION '{table.path(root)}'"
        )
        names.append(name)
    return names
