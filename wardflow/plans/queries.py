"""One query per operator, over inputs derived from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, MapType, TimestampType

from wardflow.config import RETENTION_DAYS, STAFFING_COLUMNS, VALIDATION_RULES
from wardflow.functions import adt, staffing
from wardflow.operators import census, control, dedup, facts, features, marts, ops, quality, scd2, upsert
from wardflow.plans import fixtures, jobs
from wardflow.schemas import SCHEMA_NAMES, TABLES, create_all_tables
from wardflow.sources import landing, tables
from wardflow.streaming import adt as adt_streams
from wardflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The moments the control questions are asked for.
AS_OF = "2001-07-31 12:00:00"
SINCE = "1995-01-01 00:00:00"
HALF_WAY = "1998-06-30 00:00:00"
BEGUN = "1992-01-05 00:00:00"
LAST_ALERT = "1992-03-01 00:00:00"
RETAINED_AT = "2000-06-30"
MOVED_AT = "2001-09-01 00:00:00"
DATASET = "sftp_staffing"
CRON_LINES = [
    ("SCHEDULE_DELTA", "0,30 5-23 * * 1-5"), ("CALLOUT", "0 6 1 */3 *"), ("ROSTER", "10/25 8 13,29-31 jan-jun FRI"), ("BROKEN", "61 8 * * *"),
]


def shown(df: DataFrame) -> DataFrame:
    """Dates, times, flags, lists and maps as text, so any engine's rows compare."""

    def cell(field):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (DateType, BooleanType)):
            c = c.cast("string")
        elif isinstance(kind, ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(kind, MapType):
            pairs = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
            c = F.array_join(F.array_sort(pairs), ",")
        return c.alias(field.name)

    return df.select(*[cell(f) for f in df.schema])


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: shown(build(spark, sf_dir))
    return build


def raw(spark, sf) -> DataFrame:
    return fixtures.load(spark, sf, "staffing_raw")


def silver(spark, sf) -> DataFrame:
    return facts.silver_staffing(raw(spark, sf))


def shifts(spark, sf) -> DataFrame:
    return facts.silver_shifts(raw(spark, sf))


def judged(spark, sf) -> DataFrame:
    return quality.with_reasons(raw(spark, sf))


def all_index(spark, sf) -> DataFrame:
    """Quarantine index of the staffing rows, nothing resolved."""
    return quality.quarantine_index(quality.split_valid(raw(spark, sf))[1], STAFFING_COLUMNS)


def judged_once(spark, sf) -> DataFrame:
    """Verdicts on the rows, written once for queries that look at them several
    ways: of the cells only the hash of bad records is kept."""
    record = F.when(F.size("reasons") > 0, F.sha2(F.to_json(F.struct(*STAFFING_COLUMNS)), 256))
    verdicts = judged(spark, sf).select("_source_file", "_ingested_at", "reasons", record.alias("record_hash"))
    return tables.stage(spark, verdicts, "judged")


def judged_index(rows: DataFrame) -> DataFrame:
    """The bad records of :func:`judged_once`, as the index has them, without their cells."""
    bad = rows.filter("record_hash is not null")
    return bad.select(F.col("_source_file").alias("source_file"), F.col("_ingested_at").alias("ingestion_timestamp"), "record_hash", fixed().alias("resolved"))


def fixed():
    """Whether a record counts as corrected: a quarter do, by their hash."""
    return F.substring("record_hash", 1, 1).isin("0", "1", "2", "3")


def bad_index(spark, sf) -> DataFrame:
    """The index with the corrected records resolved."""
    return all_index(spark, sf).withColumn("resolved", fixed())


def dq_results(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    rows = (judged(spark, sf) if rows is None else rows).select(
        F.lit(DATASET).alias("dataset_name"),
        F.col("_source_file").alias("source_file"),
        F.col("_ingested_at").alias("run_timestamp"),
        "reasons",
    )
    return quality.dq_summary(rows, ["dataset_name", "source_file", "run_timestamp"])


def events_bronze(spark, sf) -> DataFrame:
    """Events as Bronze holds them: patient hashed."""
    return fixtures.load(spark, sf, "adt_raw").withColumn("patient_id", adt.deidentify("patient_id"))


def events_silver(spark, sf) -> DataFrame:
    return adt.standardize_events(events_bronze(spark, sf))


def replayed_events(spark, sf) -> DataFrame:
    """Silver events of which every tenth arrived twice."""
    events = events_silver(spark, sf)
    return events.unionByName(events.filter("seq % 10 = 0"))


def manifest(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    """Files of the staffing rows; files of one facility and month are copies."""
    return (raw(spark, sf) if rows is None else rows).groupBy(F.col("_source_file").alias("path")).agg(
        F.md5(F.first(F.concat(F.substring("_source_file", 1, 18), F.date_format("_ingested_at", "yyyyMM")))).alias(
            "file_checksum"
        ),
        F.count(F.lit(1)).alias("record_count"),
        F.max("_ingested_at").alias("received_at"),
    )


def ledger(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    return manifest(spark, sf, rows).filter(F.col("received_at") <= F.lit(HALF_WAY).cast("timestamp"))


def registry(spark, sf) -> DataFrame:
    """File registry of the staffing files, one checksum per file."""
    counts = judged(spark, sf).groupBy(F.col("_source_file").alias("source_path")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.size("reasons") > 0).alias("quarantine_count"),
        F.max("_ingested_at").alias("at"),
    )
    files = counts.withColumns(
        {
            "file_checksum": F.md5("source_path"),
            "bronze_path": F.lit("bronze/stg_staffing"),
            "hospital_id": ingest.facility_of_path("source_path"),
            "file_date": F.to_date("at"),
            "bronze_run_id": F.lit("run-1"),
        }
    )
    return control.registry_rows(files, F.col("at"))


def versions(spark, sf) -> DataFrame:
    return quality.new_schema_versions(fixtures.load(spark, sf, "file_headers"))


def dim_before(spark, sf) -> DataFrame:
    return scd2.first_load(fixtures.load(spark, sf, "attributes_1"), "2024-01-01")


def schedule(spark, sf) -> DataFrame:
    return control.migrate_file_schedule(fixtures.load(spark, sf, "old_schedule"))


# --- Sources and sinks --------------------------------------------------------


def _write_csv(df: DataFrame, path: str, **options) -> None:
    writer = df.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
    for key, value in {"ignoreTrailingWhiteSpace": "false", **options}.items():
        writer = writer.option(key, value)
    writer.csv(path)


@contextmanager
def _unsorted_folders(spark):
    """A task's few folders are written side by side, its rows not sorted by them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _landing_files(spark, sf) -> str:
    """The staffing rows as three drops: plain, tab-separated and gzipped
    files, with reordered and with additional columns."""
    root = tables.scratch_path(spark, "landing")
    rows = tables.stage(spark, raw(spark, sf).select(*STAFFING_COLUMNS, "_record_index"), "rows").withColumnRenamed(
        "_record_index", "sent_id"
    )
    part = F.pmod(F.xxhash64("sent_id"), F.lit(3))
    turned = ["sent_id", *reversed(STAFFING_COLUMNS)]
    _write_csv(rows.filter(part == 0), f"{root}/FAC_A")
    _write_csv(rows.filter(part == 1).select(*turned).withColumn("agency_hours", F.length("sent_id").cast("string")),
               f"{root}/FAC_B", compression="gzip")
    _write_csv(rows.filter(part == 2).select(*turned), f"{root}/FAC_C", sep="\t", extension="tsv")
    return root


def _as_read(df: DataFrame) -> DataFrame:
    return df.select("sent_id", *STAFFING_COLUMNS)


@query
def landing_scan(spark, sf):
    """Files of three layouts read back as one frame."""
    return _as_read(landing.read_landing(spark, _landing_files(spark, sf)))


@query
def header_evolution(spark, sf):
    """Rows per role, and how many carry the column only one layout sends."""
    return landing.read_landing(spark, _landing_files(spark, sf)).groupBy("role_code").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("facility_id").alias("with_facility"),
        F.sum(F.length("shift_type")).alias("shift_chars"),
        F.max(F.col("agency_hours").isNotNull()).alias("any_agency_hours"),
        F.min(F.col("agency_hours").isNotNull()).alias("all_agency_hours"),
    )


def _ingested(spark, sf) -> str:
    """Bronze built by the ingestion stream, run twice over growing input."""
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, raw(spark, sf).select(*STAFFING_COLUMNS, "_record_index"), "rows").withColumnRenamed(
        "_record_index", "sent_id"
    )
    first = F.col("sent_id").substr(-1, 1).cast("int") % 2 == 0
    _write_csv(rows.filter(first), f"{root}/landing/FAC_A")
    ingest.ingest_bronze(spark, f"{root}/landing", root, f"{root}/checkpoints/bronze")
    more = rows.filter(~first).select("sent_id", *reversed(STAFFING_COLUMNS)).withColumn("agency_hours", F.lit("8"))
    _write_csv(more, f"{root}/landing/FAC_B")
    _write_csv(more, f"{root}/landing/FAC_B_resent")  # same content: skipped by checksum
    ingest.ingest_bronze(spark, f"{root}/landing", root, f"{root}/checkpoints/bronze")
    ingest.ingest_bronze(spark, f"{root}/landing", root, f"{root}/checkpoints/bronze")
    return root


@query
def ingest_bronze(spark, sf):
    """Valid rows in Bronze after incremental ingestion."""
    return _as_read(ingest.read_bronze(spark, _ingested(spark, sf)))


def _by_sender(df: DataFrame):
    """Grouped by the folder a file lies in; a copy has whichever folder came first."""
    return df.groupBy(F.regexp_replace(ingest.facility_of_path("source_file"), "_resent$", "").alias("sender"))


@query
def ingest_control_rows(spark, sf):
    """Counts and rules the ingestion recorded for each sender's files."""
    root = _ingested(spark, sf)
    results = tables.read_table(spark, TABLES["data_quality_results"], root)
    return _by_sender(results).agg(
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("quarantined").alias("quarantined"),
        *[F.sum(F.coalesce(F.col("error_summary")[r], F.lit(0))).alias(r.lower()) for r in VALIDATION_RULES],
    )


@query
def audit_records(spark, sf):
    """Records per audit line of ingested files, read back from JSON."""
    root = _ingested(spark, sf)
    lines = spark.read.schema(
        "file_checksum STRING, source_file STRING, total_records BIGINT, quarantined BIGINT, quality_status STRING"
    ).json(f"{root}/audit/ingestion")
    registered = tables.read_table(spark, TABLES["file_registry"], root).select("file_checksum", "source_path")
    known = lines.join(registered, ["file_checksum"])
    return _by_sender(known).agg(
        F.sum("total_records").alias("records"),
        F.sum("quarantined").alias("quarantined"),
        F.count_if(F.col("source_file") != F.col("source_path")).alias("other_path"),
        F.count_if((F.col("quarantined") == 0) != (F.col("quality_status") == "PASS")).alias("other_status"),
    )


@query
def lineage_columns(spark, sf):
    """Lineage of ingested rows: without the clock and the random index itself."""
    rows = ingest.read_bronze(spark, _ingested(spark, sf))
    return _by_sender(rows.withColumn("source_file", F.col("_source_file"))).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("_record_index").alias("indexes"),
        F.count("_ingested_at").alias("timed"),
        F.count_distinct("_ingested_at").alias("times"),
    )


@query
def odd_headers(spark, sf):
    """Bronze from files with upper-case, reordered, repeated and missing names
    and with rows longer than their header; what was turned away, by rule."""
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, raw(spark, sf).select(*STAFFING_COLUMNS, "_record_index"), "rows").withColumnRenamed(
        "_record_index", "sent_id"
    )
    part = F.pmod(F.length("sent_id") + F.col("sent_id").substr(-1, 1).cast("int"), F.lit(4))
    drop = f"{root}/landing"
    _write_csv(rows.filter(part == 0).select(*[F.col(c).alias(c.upper()) for c in rows.columns]), f"{drop}/UPPER")
    turned = [F.col(c).alias(f" {c.title()} ") for c in reversed(rows.columns)]
    _write_csv(rows.filter(part == 1).select(*turned), f"{drop}/TURNED")
    names, cells = ",".join(rows.columns), [F.coalesce(c, F.lit("")) for c in rows.columns]
    for name, header, more in (("LONGER", names, ["x", "y"]), ("TWICE", f"{names},Role_Code", ["RN"]), ("UNNAMED", f"{names},", ["z"])):
        # The header is the name of the one column of ready lines, and so written first.
        lines = rows.filter(part == (2 if name == "LONGER" else 3)).select(
            F.col("sent_id").substr(-1, 1).alias("file"), F.concat_ws(",", *cells, *[F.lit(m) for m in more]).alias(header)
        )
        plain = {"header": "true", "quote": "", "escapeQuotes": "false", "sep": "\u0001"}
        if name == "LONGER":
            lines.drop("file").write.options(**plain).csv(f"{drop}/{name}")
            continue
        # These files count, not their lines: one for each last digit.
        with _unsorted_folders(spark):
            lines.repartition("file").write.partitionBy("file").options(**plain).csv(f"{drop}/{name}")
    ingest.ingest_bronze(spark, drop, root, f"{root}/checkpoints/bronze")
    bronze = ingest.read_bronze(spark, root).groupBy(F.lit("BRONZE").alias("outcome")).agg(
        F.count(F.lit(1)).alias("records"), F.count("facility_id").alias("with_facility"), F.count_distinct("sent_id").alias("sent_ids")
    )
    index = tables.read_table(spark, TABLES["quarantine_index"], root)
    turned_away = index.groupBy(F.element_at("quarantine_reason", 1).alias("outcome")).agg(
        F.count(F.lit(1)).alias("records"), F.count("facility_id").alias("with_facility"), F.lit(0).cast("bigint").alias("sent_ids")
    )
    return bronze.unionByName(turned_away)


@query
def resent_files(spark, sf):
    """Files of each role and facility, sent again and sent in another order:
    how many there are, and how many contents by their checksums."""
    root = tables.scratch_path(spark, "landing")
    rows = raw(spark, sf).select("role_code", F.coalesce("facility_id", F.lit("none")).alias("facility"), "_record_index", "work_date")
    rows = tables.stage(spark, rows, "rows")
    forward, backward = F.col("_record_index").asc(), F.col("_record_index").desc()
    for name, order in (("first", forward), ("again", forward), ("turned", backward)):
        spread = rows.repartition("role_code", "facility").sortWithinPartitions("role_code", "facility", order)
        spread.write.partitionBy("role_code", "facility").option("header", "true").csv(f"{root}/{name}")
    found = landing.file_manifest(spark, root)
    role = F.regexp_extract("path", "role_code=([^/]*)", 1).alias("role_code")
    fresh = landing.new_files(found, found.limit(0)).groupBy(role).agg(F.count(F.lit(1)).alias("contents"))
    return found.groupBy(role).agg(F.count(F.lit(1)).alias("files")).join(fresh, "role_code")


def _bronze_batch(spark, root: str, rows: DataFrame, batch: str) -> None:
    """Rows as an ingestion batch leaves them: in Bronze, and in the ledger."""
    placed = rows.withColumns({"_ingest_date": F.to_date("_ingested_at"), "_ingest_batch": F.lit(batch)})
    path = TABLES["stg_staffing"].path(root)
    # A batch is one day, of any size: the hint splits it over tasks where a hash of the day could not.
    placed.hint("rebalance", "_ingest_date").write.mode("append").partitionBy("_ingest_date", "_ingest_batch").parquet(path)
    ledger = spark.createDataFrame([(batch, "f", path, 0, 0, None)], TABLES["ingestion_ledger"].struct)
    tables.append_batch(ledger, TABLES["ingestion_ledger"].path(root), batch)


def _three_stamps(spark, sf) -> DataFrame:
    """All staffing rows, stamped as if three batches had brought them."""
    stamp = F.lit("1997-06-01").cast("timestamp") + F.expr("make_dt_interval(cast(dayofmonth(_ingested_at) % 3 as int))")
    return raw(spark, sf).withColumn("_ingested_at", stamp)


@query
def late_batch_silver(spark, sf):
    """Silver after a batch that was stamped before the one already taken in,
    and after a run that broke off half-way."""
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, _three_stamps(spark, sf), "rows")
    late = F.col("_ingested_at") < F.lit("1997-06-03").cast("timestamp")
    _bronze_batch(spark, root, rows.filter(~late), "b-2")
    jobs.run_silver(spark, root)
    _bronze_batch(spark, root, rows.filter(late), "b-1")
    # As if a run had written the half of one table and then been lost.
    half = facts.silver_staffing(rows.filter(late)).filter("crc32(staffing_id) % 2 = 0")
    upsert.upsert_table(spark, TABLES["staffing_standardized"], root, half, newest_by=facts.NEWEST_FIRST)
    jobs.run_silver(spark, root)
    return tables.read_table(spark, TABLES["staffing_standardized"], root).drop("_source_file")


@query
def late_batch_gold(spark, sf):
    """The overtime fact by two Gold runs, the second over a late batch."""
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, _three_stamps(spark, sf), "rows")
    late = F.col("_ingested_at") < F.lit("1997-06-03").cast("timestamp")
    for batch, part in (("b-2", rows.filter(~late)), ("b-1", rows.filter(late))):
        _bronze_batch(spark, root, part, batch)
        jobs.run_silver(spark, root)
        jobs.run_gold(spark, root, "1997-07-01")
    return tables.read_table(spark, TABLES["fact_overtime"], root)


@query
def schema_hints(spark, sf):
    """Columns a catalog table hints at, with the rows that fill them."""
    path = tables.scratch_path(spark, "hinted")
    raw(spark, sf).select(*STAFFING_COLUMNS).write.parquet(path)
    name = "hinted_" + path[-8:]
    tables.register_table(spark, f"default.{name}", path)
    hints = landing.get_schema_hints(spark, name, "default")
    df = spark.read.schema(hints).parquet(path)
    spark.sql(f"DROP TABLE default.{name}")
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in df.columns])
    return counts.select(F.inline(cells))


@query
def registered_table(spark, sf):
    """Rows per role of a registered external table."""
    path = tables.scratch_path(spark, "external")
    raw(spark, sf).select("role_code", "facility_id").write.parquet(path)
    name = "external_" + path[-8:]
    tables.register_table(spark, f"default.{name}", path)
    tables.register_table(spark, f"default.{name}", path)
    out = spark.table(f"default.{name}").groupBy("role_code").agg(F.count(F.lit(1)).alias("records"))
    spark.sql(f"DROP TABLE default.{name}")
    return out


@query
def partitioned_create(spark, sf):
    """Silver written by date and read back through partition pruning."""
    root, table = tables.scratch_path(spark, "silver"), TABLES["staffing_standardized"]
    tables.write_table(silver(spark, sf), table, root)
    undated = tables.read_stored(spark, table, root).filter("month_key is null").select(*table.struct.names)
    early, late = (tables.read_days(spark, table, root, *d) for d in (("0001-01-01", "1996-12-17"), ("1996-12-18", "9999-12-31")))
    return early.unionByName(late).unionByName(undated).drop("_source_file")


@query
def feature_snapshot(spark, sf):
    """Two full rewrites of the feature table; readers see the last."""
    root, table = tables.scratch_path(spark, "lake"), TABLES["overtime_features"]
    rows = features.overtime_features(facts.fact_staffing(silver(spark, sf)))
    tables.write_snapshot(spark, rows.filter("staff_count > 10").drop("is_weekend"), table.path(root), table)
    tables.write_snapshot(spark, rows, table.path(root), table)
    return tables.read_snapshot(spark, table, root)


@query
def source_guard(spark, sf):
    """Early-exit code per source: none when rows exist."""
    sources = {
        "staffing": (raw(spark, sf), "NO_NEW_RECORDS"),
        "events after 2100": (events_bronze(spark, sf).filter("arrived_at > '2100-01-01'"), "NO_BRONZE_DATA"),
        "facts": (facts.fact_staffing(silver(spark, sf)), "NO_GOLD_DATA"),
    }
    codes = []
    for name, (df, code) in sources.items():
        try:
            tables.require_rows(df, code)
            codes.append((name, "ROWS"))
        except tables.NothingToDo as nothing:
            codes.append((name, nothing.code))
    return spark.createDataFrame(codes, "source STRING, outcome STRING")


def envelopes(spark, sf) -> DataFrame:
    """Stream envelopes of the events; some payloads are broken."""
    payload = F.to_json(
        F.struct(
            F.when(F.col("seq") % 53 != 0, F.col("event_type")).alias("event_type"),
            "facility_id", "unit_id", "patient_id", "event_timestamp", "bed_id", "attending_role",
        )
    )
    data = (
        F.when(F.col("seq") % 50 == 0, F.lit("!!"))
        .when(F.col("seq") % 51 == 0, F.base64(F.lit("plain text").cast("binary")))
        .otherwise(F.base64(payload.cast("binary")))
    )
    return fixtures.load(spark, sf, "adt_raw").select(
        F.concat(F.lit("shard-"), (F.col("seq") % 4).cast("string")).alias("partitionKey"),
        F.lpad(F.col("seq").cast("string"), 12, "0").alias("sequenceNumber"),
        F.col("arrived_at").alias("approximateArrivalTimestamp"),
        data.alias("data"),
        "seq",
    )


def _event_lake(spark, sf, drop_replays: bool = False) -> str:
    """Bronze and Silver events built by the two streams, run twice.

    The second delivery repeats every tenth envelope, and brings two thirds of
    all events for the first time: as old as any of the first delivery, and
    undated ones.
    """
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, envelopes(spark, sf), "envelopes")
    first = F.col("seq") % 3 == 0

    def run() -> None:
        stream = adt_streams.file_envelopes(spark, f"{root}/stream")
        adt_streams.run_bronze_events(stream, root, f"{root}/checkpoints/bronze")
        adt_streams.run_silver_events(spark, root, f"{root}/checkpoints/silver", drop_replays)

    rows.filter(first).drop("seq").write.mode("append").json(f"{root}/stream")
    run()
    rows.filter(~first | (F.col("seq") % 10 == 0)).drop("seq").write.mode("append").json(f"{root}/stream")
    run()
    return root


@query
def event_bronze_stream(spark, sf):
    """Decoded events after two stream runs."""
    root = tables.scratch_path(spark, "lake")
    envelopes(spark, sf).drop("seq").write.json(f"{root}/stream")
    for _ in range(2):
        stream = adt_streams.file_envelopes(spark, f"{root}/stream")
        adt_streams.run_bronze_events(stream, root, f"{root}/checkpoints/bronze")
    return tables.read_table(spark, TABLES["adt_events_raw"], root).drop("_processed_at")


@query
def event_silver_stream(spark, sf):
    """Standardised events after two runs of both streams, replays included."""
    root = _event_lake(spark, sf)
    return tables.read_table(spark, TABLES["adt_events_standardized"], root).select(
        "_kinesis_sequence", "event_id", "event_ts", "event_date", "event_hour", "event_type_std", "census_delta"
    )


@query
def replay_safe_stream(spark, sf):
    """All Silver events when the stream drops replays itself."""
    root = _event_lake(spark, sf, True)
    return tables.read_table(spark, TABLES["adt_events_standardized"], root).select(
        "event_id", "facility_id", "unit_id", "event_ts", "event_type_std"
    )


@query
def census_stream(spark, sf):
    """Hourly census kept by the stream over replayed events."""
    root = _event_lake(spark, sf)
    adt_streams.run_census_stream(spark, root, f"{root}/checkpoints/census")
    return tables.read_table(spark, TABLES["fact_census_realtime"], root)


def _validated_lake(spark, sf) -> str:
    root = tables.scratch_path(spark, "lake")
    envelopes(spark, sf).drop("seq").write.json(f"{root}/stream")
    stream = adt_streams.file_envelopes(spark, f"{root}/stream")
    adt_streams.run_validated_events(spark, stream, root, f"{root}/checkpoints/validate")
    return root


@query
def realtime_runs(spark, sf):
    """Runs, bookmarks and log lines of two realtime runs: one that finds all
    events, and one whose envelopes lack their payload."""
    root = tables.scratch_path(spark, "lake")
    envelopes(spark, sf).drop("seq").write.json(f"{root}/stream")
    stream = adt_streams.file_envelopes(spark, f"{root}/stream")
    jobs.run_realtime(spark, stream, root)
    try:
        jobs.run_realtime(spark, stream.drop("data"), root)
    except Exception as error:
        assert "data" in str(error)
    runs = control.current_runs(tables.read_table(spark, TABLES["pipeline_runs"], root))
    marks = tables.read_table(spark, TABLES["job_bookmark"], root).groupBy("job_name").agg(F.sum("record_count").alias("marked"))
    log = tables.read_table(spark, TABLES["pipeline_log"], root).groupBy("pipeline_name", "status").agg(F.count(F.lit(1)).alias("logged"))
    return (
        runs.join(log, ["pipeline_name", "status"])
        .join(marks, F.col("job_name") == F.col("pipeline_name"), "left")
        .select("pipeline_name", "layer", "status", "records_read", "logged", "marked", F.col("error_message").isNotNull().alias("failed"))
    )


@query
def realtime_json(spark, sf):
    """Valid events per date, read back from the JSON folders."""
    root = _validated_lake(spark, sf)
    return (
        spark.read.schema(adt.PAYLOAD_DDL + ", date DATE").json(f"{root}/bronze/realtime_json")
        .groupBy("date", "facility_id").agg(F.count(F.lit(1)).alias("events"))
    )


@query
def realtime_quarantine(spark, sf):
    """Events the stream validator turned away, by reason."""
    root = _validated_lake(spark, sf)
    index = tables.read_table(spark, TABLES["quarantine_index"], root)
    return ops.quarantine_by_rule(index)


@query
def payload_decode(spark, sf):
    """Outcome of decoding each envelope."""
    text = adt.decode_payload("data")
    return envelopes(spark, sf).withColumn("text", text).select(
        "sequenceNumber",
        F.col("text").isNotNull().alias("is_base64"),
        adt.parse_payload(F.col("text"))["event_type"].alias("event_type"),
        adt.parse_payload(F.col("text"))["bed_id"].alias("bed_id"),
    )


@query
def stream_metadata(spark, sf):
    """Envelope columns kept beside each event; of the clock, that it ran."""
    return adt.bronze_events(envelopes(spark, sf)).select(
        "_kinesis_partition", "_kinesis_sequence", "_kinesis_timestamp", F.col("_processed_at").isNotNull().alias("processed")
    )


# --- Validation and quality ---------------------------------------------------


@query
def duplicate_files(spark, sf):
    """Files to ingest: new content, one per checksum."""
    return landing.new_files(manifest(spark, sf), ledger(spark, sf)).select("path", "file_checksum", "record_count")


@query
def validation_reasons(spark, sf):
    return judged(spark, sf).select("_record_index", "reasons")


@query
def split_valid(spark, sf):
    """Valid and bad rows per facility; together they are all rows."""
    valid, bad = quality.split_valid(raw(spark, sf))
    both = valid.select("facility_id", F.lit("valid").alias("side")).unionByName(
        bad.select("facility_id", F.lit("bad").alias("side"))
    )
    return both.groupBy("facility_id", "side").agg(F.count(F.lit(1)).alias("records"))


@query
def quarantine_index(spark, sf):
    return all_index(spark, sf)


@query
def quarantine_queue(spark, sf):
    """Distinct messages when every file is delivered twice."""
    index = all_index(spark, sf)
    again = index.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 5 MINUTES"))
    return quality.quarantine_queue(index.unionByName(again)).select(
        "source_file", "ingestion_timestamp", "quarantine_reason", "record_hash"
    )


@query
def dq_summary(spark, sf):
    return dq_results(spark, sf)


@query
def dq_summary_by_facility(spark, sf):
    """The summary on a hot grouping key."""
    return quality.dq_summary(judged(spark, sf), ["facility_id"])


@query
def schema_registry(spark, sf):
    return versions(spark, sf).select("dataset_name", "schema_version", "columns", "registered_at")


@query
def schema_registry_insert(spark, sf):
    """Versions added by files after the registry was begun."""
    headers = fixtures.load(spark, sf, "file_headers")
    half = F.col("seen_at") <= F.lit(BEGUN).cast("timestamp")
    known = quality.new_schema_versions(headers.filter(half))
    return quality.new_schema_versions(headers.filter(~half), known).select("dataset_name", "schema_version")


@query
def dq_flags(spark, sf):
    return facts.typed_staffing(raw(spark, sf)).select("_record_index", "_dq_flags")


@query
def remediation(spark, sf):
    """Quarantined records by facility, rule and state after a file of corrections
    came in: a quarter of the records whose facility is known, put right."""
    root = tables.scratch_path(spark, "lake")
    rows = tables.stage(spark, raw(spark, sf).select(*STAFFING_COLUMNS), "rows")
    _write_csv(rows, f"{root}/landing/FAC_A")
    ingest.ingest_bronze(spark, f"{root}/landing", root, f"{root}/checkpoints/bronze")
    bad = all_index(spark, sf).filter(fixed() & F.col("facility_id").isNotNull())
    cells = F.from_json("raw_record", ", ".join(f"{c} STRING" for c in STAFFING_COLUMNS))
    right = {"staff_count": F.lit("5"), "patient_census": F.lit("50"), "hours_worked_overtime": F.lit("4")}
    _write_csv(bad.select(cells.alias("c")).select("c.*").withColumns(right), f"{root}/landing/FAC_B")
    ingest.ingest_bronze(spark, f"{root}/landing", root, f"{root}/checkpoints/bronze")
    index = jobs.read_quarantine(spark, root)
    return index.groupBy("facility_id", F.element_at("quarantine_reason", 1).alias("rule"), "resolved").agg(F.count(F.lit(1)).alias("records"))


@query
def schema_drift(spark, sf):
    return quality.schema_drift(versions(spark, sf))


@query
def schema_changes(spark, sf):
    """What each version adds or lacks against those before it."""
    return quality.schema_changes(versions(spark, sf))


@query
def parsed_events(spark, sf):
    return adt.bronze_events(envelopes(spark, sf)).drop("_processed_at", "_kinesis_timestamp")


@query
def incremental_filter(spark, sf):
    """Rows after the watermark of a half-loaded Silver."""
    rows = raw(spark, sf)
    loaded = rows.filter(F.col("_ingested_at") <= F.lit(HALF_WAY).cast("timestamp"))
    mark = dedup.watermark(loaded).select(F.col("watermark").cast("string")).first()[0]
    return dedup.newer_than(rows, mark).select("_record_index", "_ingested_at")


@query
def duplicate_keys(spark, sf):
    """Staffing ids that occur more than once before deduplication."""
    return dedup.duplicate_keys(facts.typed_staffing(raw(spark, sf)), ["staffing_id"])


# --- Projections --------------------------------------------------------------


@query
def work_dates(spark, sf):
    return raw(spark, sf).select(
        "_record_index", "work_date", staffing.parse_work_date("work_date").alias("parsed_date")
    )


@query
def silver_casts(spark, sf):
    return staffing.cast_silver_types(raw(spark, sf)).select(
        "_record_index", "staffing_id", "staff_count", "patient_census", "hours_worked", "hours_overtime",
        "shift_type", "nurse_patient_ratio", "overtime_pct",
    )


@query
def deidentified_patients(spark, sf):
    return events_bronze(spark, sf).select("seq", "patient_id")


@query
def standard_events(spark, sf):
    return events_silver(spark, sf).select(
        "seq", "event_id", "event_ts", "event_date", "event_hour", "event_type_std", "census_delta"
    )


@query
def weekend_flags(spark, sf):
    return silver(spark, sf).filter("work_date is not null").select("work_date").distinct().select(
        "work_date", staffing.date_key("work_date").alias("date_key"), staffing.is_weekend("work_date").alias("is_weekend")
    )


@query
def error_messages(spark, sf):
    log = fixtures.load(spark, sf, "pipeline_log")
    return log.select("pipeline_id", "status", staffing.short_error("error_text").alias("error_message"))


# --- Aggregations, windows, joins ---------------------------------------------


@query
def silver_watermark(spark, sf):
    full = dedup.watermark(silver(spark, sf)).withColumn("load", F.lit("full"))
    none = dedup.watermark(silver(spark, sf).filter("_ingested_at < '1900-01-01'")).withColumn("load", F.lit("none"))
    return full.unionByName(none)


@query
def run_row_counts(spark, sf):
    """Rows read, valid and quarantined by a run, in one pass."""
    return judged(spark, sf).agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.size("reasons") == 0).alias("records_written"),
        F.count_if(F.size("reasons") > 0).alias("records_failed"),
    )


@query
def silver_staffing(spark, sf):
    return silver(spark, sf).drop("_source_file")


@query
def silver_shifts(spark, sf):
    return shifts(spark, sf).drop("_source_file")


@query
def fact_staffing(spark, sf):
    return facts.fact_staffing(silver(spark, sf))


@query
def fact_overtime(spark, sf):
    return facts.fact_overtime(shifts(spark, sf))


@query
def hourly_census(spark, sf):
    return census.hourly_census(census.unique_events(events_silver(spark, sf)))


@query
def replay_census(spark, sf):
    """The same census from events of which a tenth arrived twice."""
    return census.hourly_census(census.unique_events(replayed_events(spark, sf)))


@query
def running_census(spark, sf):
    events = census.unique_events(events_silver(spark, sf))
    return census.running_census(spark, events).select("event_id", "facility_id", "unit_id", "census")


@query
def hourly_last_census(spark, sf):
    """Last running value of each hour, by the per-event form."""
    events = census.running_census(spark, census.unique_events(events_silver(spark, sf)))
    return events.groupBy(*census.HOUR).agg(F.max_by("census", F.struct("event_ts", "event_id")).alias("census"))


@query
def overtime_features(spark, sf):
    return features.overtime_features(facts.fact_staffing(silver(spark, sf)))


@query
def known_facilities(spark, sf):
    return scd2.known_facilities(silver(spark, sf), events_silver(spark, sf))


@query
def gold_check(spark, sf):
    return facts.fact_staffing(silver(spark, sf)).agg(
        F.count(F.lit(1)).alias("records"), F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day")
    )


@query
def control_counts(spark, sf):
    """Row counts of the stored control tables."""
    root = tables.scratch_path(spark, "lake")
    control.append_registry(registry(spark, sf).withColumn("file_date", F.trunc("file_date", "year")), root, "all")
    for name, rows in (("pipeline_runs", fixtures.load(spark, sf, "run_events")), ("quarantine_index", bad_index(spark, sf))):
        table = TABLES[name]
        typed = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.struct]
        tables.append_batch(rows.select(*typed), table.path(root), "all")
    schedules = TABLES["file_schedule"]
    tables.write_snapshot(spark, schedule(spark, sf).select(*schedules.struct.names), schedules.path(root))
    return jobs.control_counts(spark, root)


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Staffing rows up to and after the half-way mark."""
    rows = raw(spark, sf)
    half = F.col("_ingested_at") <= F.lit(HALF_WAY).cast("timestamp")
    return rows.filter(half), rows.filter(~half)


@query
def upsert_silver(spark, sf):
    """The stored Silver table after two upserts."""
    table, root = TABLES["staffing_standardized"], tables.scratch_path(spark, "lake")
    for part in _halves(spark, sf):
        upsert.upsert_table(spark, table, root, facts.silver_staffing(part))
    return tables.read_table(spark, table, root).drop("_source_file")


@query
def merge_fact_staffing(spark, sf):
    """Both halves' facts merged on the fact key, without a stored table."""
    old, new = (facts.fact_staffing(facts.silver_staffing(part)) for part in _halves(spark, sf))
    return upsert.merge_rows(old, tables.stage(spark, new), TABLES["fact_staffing"].keys)


@query
def upsert_fact_staffing(spark, sf):
    """The stored staffing fact after both halves were merged into it."""
    table, root = TABLES["fact_staffing"], tables.scratch_path(spark, "lake")
    for part in _halves(spark, sf):
        upsert.upsert_table(spark, table, root, facts.fact_staffing(facts.silver_staffing(part)))
    return tables.read_table(spark, table, root)


@query
def upsert_fact_overtime(spark, sf):
    """The stored overtime fact after both halves; shifts that the second half
    corrects to no overtime have left it."""
    root = tables.scratch_path(spark, "lake")
    for part in _halves(spark, sf):
        jobs.upsert_overtime(spark, root, facts.silver_shifts(part))
    return tables.read_table(spark, TABLES["fact_overtime"], root)


@query
def upsert_census(spark, sf):
    """Census after two event batches, the second with late events."""
    root = tables.scratch_path(spark, "lake")
    events = events_silver(spark, sf).withColumns(
        {
            "_kinesis_partition": F.lit("0"),
            "_kinesis_sequence": F.col("seq").cast("string"),
            "_kinesis_timestamp": F.col("arrived_at"),
            "_processed_at": F.col("arrived_at"),
        }
    )
    adt_table = TABLES["adt_events_standardized"]
    for batch in (events.filter("seq % 7 <> 0"), events.filter("seq % 7 = 0 or seq % 10 = 0")):
        rows = tables.stage(spark, batch.select(*adt_table.struct.names), "events")
        rows.write.mode("append").partitionBy("event_date").parquet(adt_table.path(root))
        adt_streams.update_census(spark, rows, root)
    return tables.read_table(spark, TABLES["fact_census_realtime"], root)


@query
def unseen_facilities(spark, sf):
    return scd2.unseen_facilities(fixtures.load(spark, sf, "attributes_2"), dim_before(spark, sf)).select("facility_id")


@query
def changed_facilities(spark, sf):
    return scd2.changed_facilities(fixtures.load(spark, sf, "attributes_2"), dim_before(spark, sf))


@query
def seed_schedule(spark, sf):
    """The stored schedule after a seed of some facilities and one of all."""
    table, root = TABLES["file_schedule"], tables.scratch_path(spark, "lake")
    ids = scd2.known_facilities(silver(spark, sf))
    for part in (ids.filter("facility_id < 'FAC_3'"), ids):
        held = tables.read_snapshot(spark, table, root).select(*table.keys)
        upsert.upsert_table(spark, table, root, control.seed_schedule(part).join(held, table.keys, "left_anti"))
    return tables.read_snapshot(spark, table, root)


@query
def latest_fact_rows(spark, sf):
    """The twenty newest fact rows."""
    return (
        facts.fact_staffing(silver(spark, sf))
        .orderBy(F.desc("date_key"), "facility_id", "role_code")
        .select("facility_id", "role_code", "work_date", "nurse_patient_ratio", "overtime_pct")
        .limit(20)
    )


@query
def ordered_schedule(spark, sf):
    """The schedule in order, with each row's place: the order is what is asked."""
    return ops.with_places(spark, schedule(spark, sf), ["facility_id", "file_type"]).select(
        "place", "facility_id", "file_type", "schedule_cron"
    )


# --- Facility dimension -------------------------------------------------------


@query
def facility_source(spark, sf):
    ids = scd2.known_facilities(silver(spark, sf), events_silver(spark, sf))
    return scd2.facility_source(ids, fixtures.load(spark, sf, "attributes_1"))


@query
def dim_first_load(spark, sf):
    return dim_before(spark, sf).drop("facility_key")


@query
def dim_after_changes(spark, sf):
    """The dimension after a second snapshot applied twice on one day."""
    source = fixtures.load(spark, sf, "attributes_2")
    once = scd2.apply_changes(dim_before(spark, sf), source, "2024-02-01")
    return scd2.apply_changes(once, source, "2024-02-01").drop("facility_key")


@query
def scd2_audit(spark, sf):
    return scd2.audit_rows(fixtures.load(spark, sf, "attributes_2"), dim_before(spark, sf), "2024-02-01")


@query
def facility_keys(spark, sf):
    """Versions after two changes on one day, and their distinct keys."""
    dim = _changed_twice(spark, sf)
    return dim.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct("facility_key").alias("distinct_keys"),
        F.count_if(F.col("effective_to") <= F.col("effective_from")).alias("empty_ranges"),
    )


def _changed_twice(spark, sf) -> DataFrame:
    """The dimension after three snapshots, two of them on one day; the sources
    hold repeated rows and rows without an id."""
    dim = dim_before(spark, sf)
    given = fixtures.load(spark, sf, "attributes_2")
    doubled = given.unionByName(given).unionByName(given.withColumn("facility_id", F.lit(None).cast("string")))
    more = given.withColumn("bed_capacity", F.col("bed_capacity") + 1)
    for source in (doubled, more.unionByName(more)):
        ids = scd2.known_facilities(source)
        dim = tables.stage(spark, scd2.apply_changes(dim, scd2.facility_source(ids, source), "2024-02-01"), "dim")
    return dim


@query
def dim_same_day(spark, sf):
    """Versions when a second change comes on the day of the first."""
    return _changed_twice(spark, sf).drop("facility_key")


# --- Run control and operator questions ---------------------------------------


@query
def current_runs(spark, sf):
    return control.current_runs(fixtures.load(spark, sf, "run_events"))


@query
def tracked_run(spark, sf):
    """State and log of a tracked validation run, without ids and clock."""
    root = tables.scratch_path(spark, "control")

    def work(run_id: str) -> tuple[int, str | None]:
        return judged(spark, sf).filter(F.size("reasons") == 0).count(), AS_OF

    jobs.tracked(spark, root, "Validation", "BRONZE", "staffing_raw", work, "MANUAL")
    run = control.current_runs(tables.read_table(spark, TABLES["pipeline_runs"], root)).select(
        "pipeline_name", "layer", "triggered_by", "status", "records_read", "records_written", "records_failed",
        "watermark_to", (F.col("duration_seconds") >= 0).alias("timed"),
    )
    log = tables.read_table(spark, TABLES["pipeline_log"], root).select(
        F.col("pipeline_name").alias("logged_name"), F.col("status").alias("logged_status"), "records_processed", "records_quarantined"
    )
    return run.join(log, F.col("pipeline_name") == F.col("logged_name")).drop("logged_name")


@query
def created_tables(spark, sf):
    """Tables of each schema once they were created twice, and the rows Silver shows."""
    prefix, root = f"made_{uuid.uuid4().hex[:8]}_", tables.scratch_path(spark, "lake")
    rows_in = facts.silver_staffing(raw(spark, sf))
    for _ in range(2):
        names = create_all_tables(spark, root, prefix)
    upsert.upsert_table(spark, TABLES["staffing_standardized"], root, rows_in)
    silver_name = f"{prefix}silver.staffing_standardized"
    spark.sql(f"ALTER TABLE {silver_name} RECOVER PARTITIONS")
    rows = spark.table(silver_name).count()
    made = {s: spark.catalog.listTables(f"{prefix}{s}") for s in SCHEMA_NAMES}
    counts = [(s, len(found), rows if s == "silver" else 0) for s, found in made.items()]
    assert len(names) == sum(len(found) for found in made.values())
    for s in SCHEMA_NAMES:
        spark.sql(f"DROP SCHEMA {prefix}{s} CASCADE")
    return spark.createDataFrame(counts, "schema_name STRING, tables BIGINT, rows BIGINT")


@query
def file_registry(spark, sf):
    return registry(spark, sf)


@query
def file_layer_status(spark, sf):
    """Registry after Silver: files with a surviving Silver row move on."""
    files = registry(spark, sf)
    reached = control.files_reaching_layer(files, silver(spark, sf))
    at = F.lit(MOVED_AT).cast("timestamp")
    moved = control.layer_status_rows(reached, "silver", "TRANSFORMED", "run-2", at)
    return control.current_files(files.unionByName(moved)).select(
        "source_path", "bronze_status", "silver_status", "gold_status", "silver_at", "run_id"
    )


@query
def job_bookmarks(spark, sf):
    return control.current_bookmarks(fixtures.load(spark, sf, "job_bookmarks"))


@query
def migrate_file_schedule(spark, sf):
    return schedule(spark, sf)


def cron_schedule(spark, sf) -> DataFrame:
    """Schedules of other files of the facilities: lists, ranges and steps, and one that cannot be read."""
    lines = F.array(*[F.struct(F.lit(kind).alias("file_type"), F.lit(cron).alias("schedule_cron")) for kind, cron in CRON_LINES])
    base = schedule(spark, sf).drop("file_type", "schedule_cron")
    return base.select("*", F.inline(lines)).select(*TABLES["file_schedule"].struct.names)


@query
def missed_files(spark, sf):
    every = schedule(spark, sf).unionByName(cron_schedule(spark, sf))
    return control.missed_files(every, fixtures.load(spark, sf, "arrivals"), AS_OF, SINCE).select(
        "facility_id", "file_type", "schedule_cron", "last_received_at", "consecutive_misses", "severity"
    )


@query
def quarantine_unresolved(spark, sf):
    return ops.quarantine_unresolved(bad_index(spark, sf)).select("source_file", "record_hash")


@query
def quarantine_by_rule(spark, sf):
    return ops.quarantine_by_rule(bad_index(spark, sf))


@query
def quarantine_by_file(spark, sf):
    """Bad records of the file that holds the most of them."""
    index = bad_index(spark, sf)
    top = ops.files_with_quarantine(index).orderBy(F.desc("records"), "source_file").first()
    return ops.quarantine_by_file(index, top.source_file).select("source_file", "quarantine_reason", "record_hash")


@query
def files_with_quarantine(spark, sf):
    return ops.files_with_quarantine(bad_index(spark, sf))


@query
def dq_trend(spark, sf):
    return ops.dq_trend(dq_results(spark, sf), DATASET, AS_OF[:10], 365)


@query
def job_status(spark, sf):
    return ops.job_status(fixtures.load(spark, sf, "pipeline_log"), "1997-01-15").drop("error_text")


@query
def pipeline_failures(spark, sf):
    return ops.pipeline_failures(fixtures.load(spark, sf, "pipeline_log"), AS_OF, 365).select(
        "pipeline_id", "pipeline_name", "event_timestamp"
    )


@query
def pipeline_runs(spark, sf):
    return ops.pipeline_runs(fixtures.load(spark, sf, "run_events"), AS_OF, 365)


@query
def duplicate_check(spark, sf):
    """The ledger entries of one checksum (facility and month)."""
    wanted = ledger(spark, sf).agg(F.min("file_checksum")).first()[0]
    return ops.duplicate_check(ledger(spark, sf), wanted).select("file_checksum", "path", "record_count")


@query
def health_check(spark, sf):
    rows = judged_once(spark, sf)
    return ops.health_check(
        ledger(spark, sf, rows), judged_index(rows), dq_results(spark, sf, rows), versions(spark, sf),
        fixtures.load(spark, sf, "job_bookmarks"), fixtures.load(spark, sf, "pipeline_log"), AS_OF,
    )


@query
def alerts(spark, sf):
    rows = judged_once(spark, sf)
    return ops.alerts(dq_results(spark, sf, rows), fixtures.load(spark, sf, "job_bookmarks"), judged_index(rows), AS_OF, versions(spark, sf), LAST_ALERT)


@query
def quarantine_of_facility(spark, sf):
    """Bad records of one facility in one week."""
    return ops.quarantine_of_facility(bad_index(spark, sf), "FAC_1", "1998-03-31").select(
        "source_file", "ingestion_timestamp", "record_hash"
    )


@query
def retention(spark, sf):
    """Rows kept per layer for a fixed day."""
    rows = raw(spark, sf).withColumn("day", F.to_date("_ingested_at"))
    parts = [
        ops.within_retention(rows, "day", AS_OF[:10], RETENTION_DAYS[layer])
        .agg(F.count(F.lit(1)).alias("records"), F.min("day").alias("oldest"))
        .withColumn("layer", F.lit(layer))
        for layer in RETENTION_DAYS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def retention_job(spark, sf):
    """Rows and oldest day that the retention job, run twice, leaves of each layer."""
    root = tables.scratch_path(spark, "lake")
    path = {name: table.path(root) for name, table in TABLES.items()}
    rows = tables.stage(spark, raw(spark, sf), "rows")
    rows.withColumn("_ingest_date", F.to_date("_ingested_at")).hint("rebalance", "_ingest_date").write.partitionBy("_ingest_date").parquet(path["stg_staffing"])
    tables.write_table(facts.silver_staffing(rows), TABLES["staffing_standardized"], root)
    tables.write_table(facts.fact_overtime(facts.silver_shifts(rows)), TABLES["fact_overtime"], root)
    quarter = F.concat(F.year("ingestion_timestamp"), F.lit("-"), F.quarter("ingestion_timestamp"))
    index = quality.quarantine_index(quality.split_valid(rows)[1], STAFFING_COLUMNS)
    index.withColumn("_batch", quarter).hint("rebalance", "_batch").write.partitionBy("_batch").parquet(path["quarantine_index"])
    fixtures.load(spark, sf, "pipeline_log").write.parquet(path["pipeline_log"])
    first_days = rows.withColumn("date", F.to_date("_ingested_at")).filter("day(date) = 1").select("date", "facility_id")
    first_days.hint("rebalance", "date").write.partitionBy("date").json(f"{root}/audit/ingestion")
    _write_csv(rows.select(*STAFFING_COLUMNS), f"{root}/landing/FAC_A")  # too new to go
    for _ in range(2):
        jobs.run_retention(spark, root, RETAINED_AT, f"{root}/landing")
    left = {
        ("landing", None): spark.read.option("header", "true").csv(f"{root}/landing/FAC_A"),
        ("bronze", "_ingest_date"): spark.read.schema("facility_id STRING, _ingest_date DATE").parquet(path["stg_staffing"]),
        ("silver", "work_date"): tables.read_table(spark, TABLES["staffing_standardized"], root),
        ("gold", "work_date"): tables.read_table(spark, TABLES["fact_overtime"], root),
        ("audit", "date"): spark.read.schema("facility_id STRING, date DATE").json(f"{root}/audit/ingestion"),
        ("quarantine", "ingestion_timestamp"): tables.read_table(spark, TABLES["quarantine_index"], root),
        ("pipeline_log", "event_timestamp"): tables.read_table(spark, TABLES["pipeline_log"], root),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("records"), F.min(F.lit(None).cast("date") if day is None else F.col(day).cast("date")).alias("oldest"))
        .withColumn("layer", F.lit(layer))
        for (layer, day), df in left.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def stored_missed_files(spark, sf):
    """Misses as the schedule table holds them after the job ran twice."""
    root, table = tables.scratch_path(spark, "lake"), TABLES["file_schedule"]
    tables.write_snapshot(spark, schedule(spark, sf).select(*table.struct.names), table.path(root))
    arrivals = fixtures.load(spark, sf, "arrivals")
    for _ in range(2):
        jobs.run_missed_files(spark, root, arrivals, AS_OF, SINCE)
    return tables.read_snapshot(spark, table, root).filter("is_active").select(
        "facility_id", "file_type", "schedule_cron", "last_received_at", "consecutive_misses"
    )


# --- KPI marts ----------------------------------------------------------------


# What a mart's rows are compared by: facility, further key, day, and four figures.
MART_COLUMNS = {
    "facility_daily_summary": ("facility_id", None, "work_date", "staff_total", "census_total", "overtime_hours", "avg_nurse_patient_ratio"),
    "np_ratio_realtime": ("facility_id", None, "as_of_date", "census_now", "staff_now", "np_ratio", None),
    "ot_summary_monthly": ("facility_id", "role_code", "month", "overtime_hours", "overtime_cost", "overtime_rows", None),
    "scorecard_quarterly": ("facility_id", None, "quarter", "avg_nurse_patient_ratio", "understaffed_share", "overtime_pct", "overtime_cost"),
    "dq_dashboard": (None, "dataset_name", "run_date", "total_records", "valid_records", "pass_rate", None),
    "dim_facility_current": ("facility_id", None, "effective_from", "bed_capacity", "staffing_benchmark", None, None),
}
MART_KINDS = ["string", "string", "date", "double", "double", "double", "double"]


@query
def stored_marts(spark, sf):
    """All six marts as stored after two Gold runs; the second run rebuilds the
    months and quarters that its half of the rows touches."""
    root = tables.scratch_path(spark, "lake")
    balances = census.closing_balances(census.hourly_census(census.unique_events(events_silver(spark, sf))))
    tables.write_table(balances, TABLES["census_balance"], root)
    results = TABLES["data_quality_results"]
    tables.append_batch(dq_results(spark, sf).select(*results.struct.names), results.path(root), "all")
    dim = scd2.apply_changes(dim_before(spark, sf), fixtures.load(spark, sf, "attributes_2"), "2024-02-01")
    tables.write_snapshot(spark, dim, TABLES["dim_facility"].path(root))
    stamp = F.lit(HALF_WAY).cast("timestamp")
    for batch, part in zip(("b-1", "b-2"), _halves(spark, sf)):
        _bronze_batch(spark, root, part.withColumn("_ingested_at", stamp), batch)
        upsert.upsert_table(spark, TABLES["fact_staffing"], root, facts.fact_staffing(facts.silver_staffing(part)))
        jobs.upsert_overtime(spark, root, facts.silver_shifts(part))
        control.mark_batches(spark, root, "gold", [batch], batch)
        jobs.run_marts(spark, root)
    names = ["facility_id", "part", "day", "v1", "v2", "v3", "v4"]
    parts = [
        jobs.read_mart(spark, root, mart).select(
            F.lit(mart).alias("mart"), *[(F.lit(None) if c is None else F.col(c)).cast(kind).alias(n) for c, kind, n in zip(columns, MART_KINDS, names)]
        )
        for mart, columns in MART_COLUMNS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def refreshed_features(spark, sf):
    """Features after a run over one half of the rows and a refresh by the other."""
    root, table = tables.scratch_path(spark, "lake"), TABLES["overtime_features"]
    stamp = F.lit(HALF_WAY).cast("timestamp")
    for batch, part in zip(("b-1", "b-2"), _halves(spark, sf)):
        _bronze_batch(spark, root, part.withColumn("_ingested_at", stamp), batch)
        upsert.upsert_table(spark, TABLES["fact_staffing"], root, facts.fact_staffing(facts.silver_staffing(part)))
        control.mark_batches(spark, root, "gold", [batch], batch)
        jobs.run_features(spark, root)
    return tables.read_snapshot(spark, table, root)


@query
def facility_daily_summary(spark, sf):
    return marts.facility_daily_summary(facts.fact_staffing(silver(spark, sf)))


@query
def np_ratio_realtime(spark, sf):
    counted = census.hourly_census(census.unique_events(events_silver(spark, sf)))
    return marts.np_ratio_realtime(counted, facts.fact_staffing(silver(spark, sf)))


@query
def ot_summary_monthly(spark, sf):
    return marts.ot_summary_monthly(facts.fact_overtime(shifts(spark, sf)))


@query
def scorecard_quarterly(spark, sf):
    return marts.scorecard_quarterly(
        facts.fact_staffing(silver(spark, sf)), facts.fact_overtime(shifts(spark, sf))
    )


@query
def dq_dashboard(spark, sf):
    return marts.dq_dashboard(dq_results(spark, sf))


@query
def dim_facility_current(spark, sf):
    after = scd2.apply_changes(dim_before(spark, sf), fixtures.load(spark, sf, "attributes_2"), "2024-02-01")
    return marts.current_facilities(after).drop("facility_key", "effective_to")
