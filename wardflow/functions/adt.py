"""Column expressions for admit / discharge / transfer events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.config import CENSUS_DELTAS, EVENT_CODES
from wardflow.functions.staffing import hash_key

# Fields of the event payload and of the stream envelope.
PAYLOAD_DDL = (
    "event_type STRING, facility_id STRING, unit_id STRING, patient_id STRING,"
    " event_timestamp STRING, bed_id STRING, attending_role STRING"
)
ENVELOPE_DDL = "partitionKey STRING, sequenceNumber STRING, approximateArrivalTimestamp TIMESTAMP, data STRING"


def decode_payload(col: str = "data") -> Column:
    """Text of a base64 payload; NULL when it is not base64."""
    return F.expr(f"cast(try_to_binary({col}, 'base64') as string)")


def parse_payload(col: Column) -> Column:
    """Struct of the event fields; every field NULL when the JSON is broken."""
    return F.from_json(col, PAYLOAD_DDL, {"mode": "PERMISSIVE"})


def deidentify(col: str) -> Column:
    """SHA-256 in place of a patient identifier."""
    return F.sha2(F.col(col).cast("string"), 256)


def parse_event_ts(col: str | Column = "event_timestamp") -> Column:
    """Timestamp from ISO text (T or blank, optional fraction, optional zone)
    or from ``MM/dd/yyyy HH:mm:ss``; NULL otherwise.

    The digit mask tells the slash form apart; both are then read by a cast,
    which yields NULL instead of a per-row exception on bad text.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    mask = F.translate(text, "123456789", "000000000")
    us_as_iso = F.concat(
        F.substring(text, 7, 4), F.lit("-"), F.substring(text, 1, 2), F.lit("-"), F.substring(text, 4, 2),
        F.substring(text, 11, 9),
    )
    iso_shape = mask.like("0000-00-00 00:00:00%") | mask.like("0000-00-00T00:00:00%")
    return F.when(mask == "00/00/0000 00:00:00", us_as_iso.try_cast("timestamp")).when(
        iso_shape, text.try_cast("timestamp")
    )


def event_type_std(col: str = "event_type") -> Column:
    """ADMIT, DISCHARGE or TRANSFER from the raw code; UNKNOWN otherwise."""
    code = F.upper(F.trim(F.col(col)))
    matches = [F.when(code.isin(spellings), F.lit(standard)) for standard, spellings in EVENT_CODES.items()]
    return F.coalesce(*matches, F.lit("UNKNOWN"))


def census_delta(col: str = "event_type_std") -> Column:
    """+1 for an admit, -1 for a discharge, 0 otherwise."""
    steps = [F.when(F.col(col) == standard, F.lit(delta)) for standard, delta in CENSUS_DELTAS.items()]
    return F.coalesce(*steps, F.lit(0))


def event_key() -> Column:
    return hash_key("facility_id", "patient_id", "event_timestamp", "event_type")


def bronze_events(envelopes: DataFrame) -> DataFrame:
    """Decoded, de-identified events with their stream metadata.

    Rows whose payload does not parse to an event type are left out.
    """
    parsed = envelopes.withColumn("e", parse_payload(decode_payload("data")))
    return parsed.filter(F.col("e.event_type").isNotNull()).select(
        "e.event_type",
        "e.facility_id",
        "e.unit_id",
        deidentify("e.patient_id").alias("patient_id"),
        "e.event_timestamp",
        "e.bed_id",
        "e.attending_role",
        F.col("partitionKey").alias("_kinesis_partition"),
        F.col("sequenceNumber").alias("_kinesis_sequence"),
        F.col("approximateArrivalTimestamp").alias("_kinesis_timestamp"),
        F.current_timestamp().alias("_processed_at"),
    )


def standardize_events(events: DataFrame) -> DataFrame:
    """Silver event: parsed time, standard type, event key and census step."""
    return (
        events.withColumn("event_ts", parse_event_ts("event_timestamp"))
        .withColumns(
            {
                "event_date": F.to_date("event_ts"),
                "event_hour": F.hour("event_ts"),
                "event_type_std": event_type_std("event_type"),
                "event_id": event_key(),
            }
        )
        .withColumn("census_delta", census_delta("event_type_std"))
    )
