"""Fixed values shared by every layer, and the session the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# --- Fixed values: data-quality thresholds and required fields ---------------
MAX_PATIENT_CENSUS = 1500
MAX_OVERTIME_HOURS = 24
REQUIRED_FIELDS = ["facility_id", "work_date", "role_code"]
UNDERSTAFFED_THRESHOLD = 0.25
OVERTIME_BLENDED_RATE = 65.0
PASS_RATE_WARN = 90.0

# --- Fixed values: columns every staffing file is expected to carry ----------
STAFFING_COLUMNS = [
    "facility_id",
    "work_date",
    "role_code",
    "staff_count",
    "patient_census",
    "hours_worked",
    "hours_worked_overtime",
    "shift_type",
]
LINEAGE_COLUMNS = ["_source_file", "_ingested_at", "_record_index"]

# --- Fixed values: accepted spellings, in order of precedence ----------------
WORK_DATE_FORMATS = [
    "MM/dd/yyyy",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "yyyyMMdd",
    "MM-dd-yyyy",
    "yyyy-MM-dd HH:mm:ss",
]
EVENT_CODES = {
    "ADMIT": ["A", "ADMIT", "ADMISSION"],
    "DISCHARGE": ["D", "DISCHARGE", "DISCH"],
    "TRANSFER": ["T", "TRANSFER", "TRANS"],
}
CENSUS_DELTAS = {"ADMIT": 1, "DISCHARGE": -1, "TRANSFER": 0}

# --- Fixed values: record rules of the file validator ------------------------
VALIDATION_RULES = [
    "NULL_FACILITY_ID",
    "CENSUS_OUT_OF_RANGE",
    "OT_HOURS_EXCEED_MAX",
    "NEGATIVE_STAFF_COUNT",
    "STAFF_COUNT_NOT_NUMERIC",
]

# --- Rules that concern the layout of a file, not a record ---------------------
LAYOUT_RULES = ["SURPLUS_CELLS", "HEADER_NOT_READABLE"]

# --- Fixed values: facility attributes whose changes open a new version ------
TRACKED_ATTRIBUTES = ["bed_capacity", "staffing_benchmark"]

# --- Fixed values: days each layer keeps its rows ----------------------------
RETENTION_DAYS = {
    "landing": 90,
    "bronze": 365,
    "silver": 3 * 365,
    "gold": 7 * 365,
    "audit": 7 * 365,
    "quarantine": 180,
    "pipeline_log": 90,
}

EPOCH = "1970-01-01 00:00:00"


def build_session(app: str = "wardflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on.

    No shuffle width is fixed here: adaptive execution starts from the
    cluster's own ``initialPartitionNum`` and coalesces or splits from there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # A run's record counts come from the reports of its micro-batches.
        "spark.sql.streaming.numRecentProgressUpdates": "100000",
        # The JVM does not compile methods above 8000 bytes; wide projections
        # past that run faster as split expressions than as one huge method.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
