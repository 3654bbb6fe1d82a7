"""Quarantined records and the corrections that resolve them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.config import STAFFING_COLUMNS
from wardflow.functions.staffing import all_of, cast_silver_types
from wardflow.operators.quality import resolve_remediated
from wardflow.schemas import TABLES
from wardflow.sources.tables import append_batch, path_exists, read_table

RESOLUTIONS = "source_file STRING, record_hash STRING"
SHIFT = ["facility_id", "work_date", "role_code", "shift_type"]


def mark_resolved(spark: SparkSession, root: str, records: DataFrame, batch: str) -> None:
    """Record that quarantined ``records`` (source_file, record_hash) were
    corrected."""
    rows = records.select("source_file", "record_hash").distinct()
    append_batch(rows, f"{root}/batch_control/quarantine_resolutions", batch)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The quarantine index with everything marked since taken into account."""
    index = read_table(spark, TABLES["quarantine_index"], root)
    path = f"{root}/batch_control/quarantine_resolutions"
    if not path_exists(spark, path):
        return index
    return resolve_remediated(index, spark.read.schema(RESOLUTIONS).parquet(path), ["source_file", "record_hash"])


def corrected_records(index: DataFrame, valid: DataFrame) -> DataFrame:
    """(source_file, record_hash) of quarantined records for whose shift there is now a valid row.

    The shift is read from the record's own cells as Silver reads them: facility,
    date in any spelling, role, and shift type. A record whose facility or date
    cannot be read names no shift and stays until it is marked by hand.
    """
    cells = F.from_json("raw_record", ", ".join(f"{c} STRING" for c in STAFFING_COLUMNS))
    held = cast_silver_types(index.select("source_file", "record_hash", cells.alias("cell")).select("source_file", "record_hash", "cell.*"))
    named = held.filter((F.col("facility_id") != "") & F.col("work_date").isNotNull())
    fixed = cast_silver_types(valid.select(*STAFFING_COLUMNS)).select(*[F.col(c).alias(f"fixed_{c}") for c in SHIFT]).distinct()
    same = all_of([F.col(c).eqNullSafe(F.col(f"fixed_{c}")) for c in SHIFT])
    return named.join(fixed, same, "left_semi").select("source_file", "record_hash").distinct()


def resolve_by_batch(spark: SparkSession, root: str, valid: DataFrame, at, batch: str) -> None:
    """Mark what a batch of valid rows, ingested ``at``, corrects of earlier batches' records."""
    if path_exists(spark, TABLES["quarantine_index"].path(root)):
        earlier = read_quarantine(spark, root).filter(~F.col("resolved") & (F.col("ingestion_timestamp") < at))
        mark_resolved(spark, root, corrected_records(earlier, valid), batch)
