"""The scheduled jobs: Silver, Gold and feature builds with run tracking."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.config import RETENTION_DAYS
from wardflow.functions.staffing import all_of, date_key
from wardflow.operators import marts, scd2
from wardflow.operators.control import (
    append_registry,
    batches_reached,
    complete_pipeline_run,
    files_reaching_layer,
    ingested_batches,
    layer_status_rows,
    mark_batches,
    migrate_file_schedule,
    missed_files,
    seed_schedule,
    start_pipeline_run,
    write_job_bookmark,
    write_pipeline_log,
)
from wardflow.operators.facts import (
    NEWEST_FIRST,
    fact_overtime,
    fact_staffing,
    shift_id,
    silver_shifts,
    silver_staffing,
    typed_staffing,
)
from wardflow.operators.features import affected_ranges, features_in, overtime_features
from wardflow.operators.remediation import mark_resolved, read_quarantine  # noqa: F401
from wardflow.operators.upsert import merge_into_version, touched_days, upsert_table
from wardflow.schemas import MONTH, TABLES, Table, create_all_tables
from wardflow.sources.tables import (
    NothingToDo,
    append_batch,
    compact_log,
    drop_folder,
    overwrite_folders,
    partition_values,
    path_exists,
    read_days,
    read_snapshot,
    read_stored,
    read_table,
    require_rows,
    snapshot_folder,
    staged,
    write_snapshot,
    write_table,
)
from wardflow.streaming.adt import run_bronze_events, run_census_stream, run_silver_events
from wardflow.streaming.ingest import ingest_bronze, read_bronze


def tracked(
    spark: SparkSession,
    root: str,
    name: str,
    layer: str,
    source: str,
    work: Callable[[str], tuple[int, str | None]],
    triggered_by: str = "SCHEDULE",
) -> str:
    """Run ``work(run_id)`` and record its outcome; returns SUCCESS or the
    code of the reason there was nothing to do. ``work`` returns the number
    of records and the watermark reached."""
    run_id = start_pipeline_run(spark, name, layer, triggered_by, root)
    began = time.monotonic()
    try:
        records, mark = work(run_id)
        outcome = "SUCCESS"
    except NothingToDo as nothing:
        records, mark, outcome = 0, None, nothing.code
    except Exception as error:
        complete_pipeline_run(spark, run_id, 0, 0, 0, error_message=str(error) or repr(error), root=root, layer=layer)
        write_pipeline_log(spark, name, 0, 0, time.monotonic() - began, "FAILED", str(error), root=root)
        raise
    reached = None
    if mark:
        reached = spark.range(1).select(F.lit(mark).cast("timestamp")).first()[0]
    complete_pipeline_run(spark, run_id, records, records, 0, reached, root=root, layer=layer)
    write_job_bookmark(spark, name, source, records, run_id, root=root)
    write_pipeline_log(spark, name, records, 0, time.monotonic() - began, root=root)
    return outcome


def _move_files(spark: SparkSession, root: str, rows: DataFrame, layer: str, status: str, run_id: str) -> None:
    """Record that the files behind ``rows`` reached a layer."""
    files = files_reaching_layer(read_table(spark, TABLES["file_registry"], root), rows)
    append_registry(layer_status_rows(files, layer, status, run_id, F.current_timestamp()), root, f"{run_id}-{layer}")


def counted(rows: DataFrame) -> tuple[Observation, DataFrame]:
    """``rows``, whose write also counts them and finds the newest ingestion time."""
    seen = Observation()
    return seen, rows.observe(seen, F.count(F.lit(1)).alias("records"), F.max("_ingested_at").cast("string").alias("mark"))


SILVER_JOB = "Silver_Transformation"


def pending_batches(spark: SparkSession, root: str, taken: DataFrame, layer: str) -> list[str]:
    """Batches of ``taken(ingest_batch)`` that ``layer`` has not finished.

    The position is the set of finished batches, written as a run's last step.
    A batch that arrives late or with an earlier time stamp is pending like any
    other, and one whose run broke off between two tables is pending again.
    """
    fresh = taken.join(batches_reached(spark, root, layer), "ingest_batch", "left_anti")
    return sorted(r.ingest_batch for r in fresh.collect())


def bronze_of(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """Bronze rows of the given batches; only their folders are read."""
    return read_bronze(spark, root).filter(F.col("_ingest_batch").isin(batches) if batches else F.lit(False))


def run_silver(spark: SparkSession, root: str) -> str:
    """Bronze rows of the batches Silver has not taken in, into both its grains."""

    def work(run_id: str) -> tuple[int, str]:
        pending = pending_batches(spark, root, ingested_batches(spark, root), "silver")
        seen, rows = counted(bronze_of(spark, root, pending))
        with staged(spark, rows, "bronze") as fresh:
            records, mark = seen.get["records"], seen.get["mark"]
            if records:
                for name, rows in (("staffing_shifts", silver_shifts(fresh)), ("staffing_standardized", silver_staffing(fresh))):
                    upsert_table(spark, TABLES[name], root, rows, newest_by=NEWEST_FIRST)
                _move_files(spark, root, fresh, "silver", "TRANSFORMED", run_id)
        if pending:
            mark_batches(spark, root, "silver", pending, run_id)
        if not records:
            raise NothingToDo("NO_NEW_RECORDS")
        return records, mark

    return tracked(spark, root, SILVER_JOB, "SILVER", TABLES["stg_staffing"].full_name, work)


def touched_silver(spark: SparkSession, root: str, name: str, keys: DataFrame) -> DataFrame:
    """Rows of a Silver table under the keys that a batch brought."""
    table = TABLES[name]
    rows = touched_days(spark, table, root, keys)
    return rows.join(keys.select(*table.keys).distinct(), table.keys, "left_semi")


def overtime_batch(spark: SparkSession, root: str, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overtime rows of changed shifts, and the keys of the stored rows whose
    shift was corrected to no overtime. Only the days of such shifts are looked
    up in the fact."""
    table = TABLES["fact_overtime"]
    keys = table.keys
    without = changed.filter("not coalesce(hours_overtime > 0, false)").withColumn("hours_overtime", F.lit(1.0))
    candidates = fact_overtime(without).select(*keys)
    held = touched_days(spark, table, root, candidates).select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    same = all_of([F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return fact_overtime(changed), candidates.join(held, same, "left_semi")


def upsert_overtime(spark: SparkSession, root: str, changed: DataFrame) -> None:
    """Bring the overtime fact up to date with changed shifts, so that it equals
    one built from all shifts."""
    table = TABLES["fact_overtime"]
    # Looked at four times, so written first.
    with staged(spark, changed, "shifts") as shifts:
        rows, cleared = overtime_batch(spark, root, shifts)
        with staged(spark, cleared, "cleared") as gone:
            upsert_table(spark, table, root, rows, cleared=gone)


def run_gold(spark: SparkSession, root: str, run_date: str, attributes: DataFrame | None = None) -> str:
    """Facts and facility dimension from the batches that Silver has finished.

    A Silver row is one fact row, so the Silver rows under a batch's keys are
    exactly the fact rows to merge. The census has one writer, the event stream;
    here its facilities only join the dimension.
    """
    name = "Gold_Unified_Analytics"
    staffing = TABLES["staffing_standardized"]

    def work(run_id: str) -> tuple[int, str]:
        pending = pending_batches(spark, root, batches_reached(spark, root, "silver"), "gold")
        events = read_table(spark, TABLES["fact_census_realtime"], root)
        with staged(spark, typed_staffing(bronze_of(spark, root, pending)), "bronze") as fresh:
            ids = scd2.known_facilities(fresh, events)
            held = read_snapshot(spark, TABLES["dim_facility"], root)
            if not pending and scd2.unseen_facilities(ids, held).isEmpty():
                raise NothingToDo("NO_NEW_RECORDS")
            keyed = fresh.withColumn("shift_id", shift_id())
            silver = touched_silver(spark, root, "staffing_standardized", keyed)
            shifts = touched_silver(spark, root, "staffing_shifts", keyed)
            seen, counted_silver = counted(silver)
            with staged(spark, counted_silver, "silver") as rows:
                records, mark = seen.get["records"], seen.get["mark"]
                if records:
                    upsert_table(spark, TABLES["fact_staffing"], root, fact_staffing(rows))
                    upsert_overtime(spark, root, shifts)
                    _move_files(spark, root, rows, "gold", "AGGREGATED", run_id)
            if attributes is None:
                source = ids.withColumns({"bed_capacity": F.lit(None).cast("int"), "staffing_benchmark": F.lit(None).cast("double")})
            else:
                source = scd2.facility_source(ids, attributes)
            run_dimension(spark, root, source, run_date)
        if pending:
            mark_batches(spark, root, "gold", pending, run_id)
        return records, mark

    return tracked(spark, root, name, "GOLD", staffing.full_name, work)


def run_dimension(spark: SparkSession, root: str, source: DataFrame, run_date: str) -> None:
    """Apply a source snapshot to the facility dimension and audit it."""
    table = TABLES["dim_facility"]
    with staged(spark, source, "facilities") as given:
        dim = read_snapshot(spark, table, root)
        # The batch id names the version the changes apply to: a retry of a
        # run that failed after the audit replaces its own audit rows.
        version = (snapshot_folder(spark, table.path(root)) or "version=none").rsplit("=", 1)[-1]
        audit = scd2.audit_rows(given, dim, run_date)
        append_batch(audit, TABLES["scd2_audit"].path(root), f"{run_date}-{version}")
        after = scd2.apply_changes(dim, given, run_date)
        typed = after.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.struct])
        write_snapshot(spark, typed, table.path(root))


def init_control(spark: SparkSession, root: str, facilities: DataFrame, prefix: str = "") -> dict[str, int]:
    """Create all tables and seed the file schedule; returns the row counts
    of the control tables. Running it again changes nothing."""
    create_all_tables(spark, root, prefix)
    schedule = TABLES["file_schedule"]
    known = read_snapshot(spark, schedule, root)
    fresh = seed_schedule(facilities).join(known.select(*schedule.keys), schedule.keys, "left_anti")
    upsert_table(spark, schedule, root, fresh)
    return {r.name: r.records for r in control_counts(spark, root).collect()}


def control_counts(spark: SparkSession, root: str) -> DataFrame:
    """(name, records) of every control table."""
    counts = []
    for name, table in TABLES.items():
        if table.schema_name == "batch_control":
            rows = read_snapshot(spark, table, root) if name == "file_schedule" else read_table(spark, table, root)
            counts.append(rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("name"), "records"))
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


# Tables that grow by a file a row, and the order their rows are folded in.
LOGS = {"pipeline_runs": ["run_id", "recorded_at"], "job_bookmark": ["job_name", "source_name", "updated_at"], "pipeline_log": ["event_timestamp"]}


def compact_logs(spark: SparkSession, root: str) -> dict[str, int]:
    """Fold the control tables that jobs append to; returns the files folded of each.

    One run at a time; readers and writers of the tables go on meanwhile.
    """
    return {name: compact_log(spark, TABLES[name], root, order) for name, order in LOGS.items()}


def run_schedule_migration(spark: SparkSession, path: str, backup_path: str, root: str) -> str:
    """Move a stored schedule of the old form into ``file_schedule``.

    The old rows are copied to ``backup_path`` first, and the row count is
    checked afterwards. A schedule already in the new form is left alone.
    """
    old = spark.read.parquet(path)
    new = migrate_file_schedule(old)
    if new is old:
        return "ALREADY_MIGRATED"
    old.write.mode("overwrite").parquet(backup_path)
    table = TABLES["file_schedule"]
    # Rows already there, such as seeds of other file types, stay.
    upsert_table(spark, table, root, new.select(*table.struct.names))
    missing = new.select(*table.keys).join(read_snapshot(spark, table, root), table.keys, "left_anti")
    if not missing.isEmpty():
        raise ValueError(f"migration left out {missing.count()} schedule rows")
    return "MIGRATED"


def run_missed_files(spark: SparkSession, root: str, arrivals: DataFrame, as_of: str, since: str) -> str:
    """Store in the schedule when each source last sent a file and how many
    expected ones are missing in a row; none where its cron cannot be read."""

    def work(run_id: str) -> tuple[int, None]:
        table = TABLES["file_schedule"]
        late = missed_files(read_snapshot(spark, table, root), arrivals, as_of, since)
        with staged(spark, late, "missed") as rows:
            upsert_table(spark, table, root, rows.select(*table.struct.names))
            return rows.filter("severity is not null").count(), None

    return tracked(spark, root, "Missed_Files", "CONTROL", TABLES["file_schedule"].full_name, work)


def registered_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """(facility_id, file_type, received_at) of the staffing files taken in."""
    files = read_table(spark, TABLES["file_registry"], root)
    return files.select(F.col("hospital_id").alias("facility_id"), F.lit("STAFFING").alias("file_type"), F.col("bronze_at").alias("received_at"))


# The layer whose limit holds for a table.
DATED_TABLES = [
    ("bronze", "stg_staffing"),
    ("silver", "staffing_standardized"),
    ("silver", "staffing_shifts"),
    ("silver", "adt_events_standardized"),
    ("gold", "fact_staffing"),
    ("gold", "fact_overtime"),
    ("gold", "fact_census_realtime"),  # its balances stay: later openings come from them
]
DATED_FOLDERS = [("audit", "audit/ingestion", "date"), ("audit", "audit/realtime", "date"), ("bronze", "bronze/realtime_json", "date")]


def _drop_days(spark: SparkSession, path: str, column: str, oldest: str) -> list[str]:
    """Drop the day folders before ``oldest``; no file is opened."""
    old = [d for d in partition_values(spark, path, column) if d[:1].isdigit() and d < oldest]
    for value in old:
        drop_folder(spark, f"{path}/{column}={value}")
    return [f"{path}/{column}={value}" for value in old]


def _drop_months(spark: SparkSession, table: Table, root: str, oldest: str) -> list[str]:
    """Drop the months before ``oldest`` unopened, and from its own month the days before it.

    That one month is rewritten, if it holds such days; every other file stays.
    """
    path, limit = table.path(root), int(oldest[:4] + oldest[5:7])
    months = [v for v in partition_values(spark, path, MONTH) if v.isdigit() and int(v) <= limit]
    changed = [f"{path}/{MONTH}={v}" for v in months if int(v) < limit]
    if str(limit) in months:
        month = read_stored(spark, table, root).filter(F.col(MONTH) == limit).select(*table.struct.names)
        kind = table.struct[table.day].dataType.simpleString()
        first = F.lit(oldest).cast("date") if kind == "date" else F.lit(int(oldest.replace("-", "")))
        if not month.filter(F.col(table.day) < first).isEmpty():
            with staged(spark, month.filter(F.col(table.day) >= first), "month") as left:
                if left.isEmpty():
                    changed.append(f"{path}/{MONTH}={limit}")
                else:
                    write_table(left, table, root)
    for folder in changed:
        drop_folder(spark, folder)
    return changed


def _drop_batches(spark: SparkSession, path: str, column: str, oldest: str) -> list[str]:
    """Drop the batch folders whose newest row is before ``oldest``."""
    if not path_exists(spark, path):
        return []
    ages = spark.read.schema(f"{column} TIMESTAMP, _batch STRING").parquet(path).groupBy("_batch").agg(F.max(column).alias("newest"))
    old = [f"{path}/_batch={r._batch}" for r in ages.filter(F.col("newest") < F.lit(oldest).cast("timestamp")).collect()]
    for folder in old:
        drop_folder(spark, folder)
    return old


def _drop_landing(spark: SparkSession, landing: str, oldest: str) -> list[str]:
    """Drop the landing files last modified before ``oldest``; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("modifiedBefore", f"{oldest}T00:00:00")
    old = [r.path for r in files.load(landing).select("path").collect()] if path_exists(spark, landing) else []
    for path in old:
        drop_folder(spark, path)
    return old


def run_retention(spark: SparkSession, root: str, as_of: str, landing: str | None = None) -> list[str]:
    """Drop what is past its layer's limit; returns the dropped folders and files.

    Rows without a date stay. A quarantine batch goes with its newest record, log
    rows as the log is folded, and a landing file by when it was last modified,
    taken in or not.
    """
    oldest = {layer: str(date.fromisoformat(as_of) - timedelta(days=days)) for layer, days in RETENTION_DAYS.items()}
    dropped = []
    for layer, name in DATED_TABLES:
        table = TABLES[name]
        if table.day:
            dropped += _drop_months(spark, table, root, oldest[layer])
        else:
            dropped += _drop_days(spark, table.path(root), table.folders[0], oldest[layer])
    for layer, path, column in DATED_FOLDERS:
        dropped += _drop_days(spark, f"{root}/{path}", column, oldest[layer])
    dropped += _drop_batches(spark, TABLES["quarantine_index"].path(root), "ingestion_timestamp", oldest["quarantine"])
    log = TABLES["pipeline_log"]
    if compact_log(spark, log, root, LOGS["pipeline_log"], F.col("event_timestamp") >= F.lit(oldest["pipeline_log"]).cast("timestamp")):
        dropped.append(log.path(root))
    if landing is not None:
        dropped += _drop_landing(spark, landing, oldest["landing"])
    return dropped


# Stored by the month or quarter of this day: a run replaces those that new batches touch.
PERIOD_MARTS = {"facility_daily_summary": "work_date", "ot_summary_monthly": "month", "scorecard_quarterly": "quarter"}
PERIOD = "period"


def _period(day: str, quarterly: bool) -> Column:
    """The month (yyyymm), or the first one of the quarter, of a day."""
    start = F.trunc(day, "quarter" if quarterly else "month")
    return (F.year(start) * 100 + F.month(start)).cast("int")


def write_period_marts(spark: SparkSession, root: str, months: list[int] | None) -> None:
    """Rebuild the marts of the given months (yyyymm), or of all.

    The facts are read in the folders of these months, and for the scorecard in
    those of their quarters.
    """
    facts = {name: read_stored(spark, TABLES[name], root) for name in ("fact_staffing", "fact_overtime")}
    first_months = None if months is None else {m // 100 * 100 + (m % 100 - 1) // 3 * 3 + 1 for m in months}
    quarters = None if first_months is None else sorted(q + i for q in first_months for i in range(3))

    def of(name: str, wanted: list[int] | None) -> DataFrame:
        rows = facts[name] if wanted is None else facts[name].filter(F.col(MONTH).isin(wanted))
        return rows.select(*TABLES[name].struct.names)

    built = {
        "facility_daily_summary": marts.facility_daily_summary(of("fact_staffing", months)),
        "ot_summary_monthly": marts.ot_summary_monthly(of("fact_overtime", months)),
        "scorecard_quarterly": marts.scorecard_quarterly(of("fact_staffing", quarters), of("fact_overtime", quarters)),
    }
    for name, rows in built.items():
        path, quarterly = f"{root}/marts/{name}", name == "scorecard_quarterly"
        with staged(spark, rows.withColumn(PERIOD, _period(PERIOD_MARTS[name], quarterly)), "mart") as fresh:
            overwrite_folders(fresh.hint("rebalance", PERIOD), path, [PERIOD])
            if months is not None:
                # A period that lost its last row has nothing to overwrite it with.
                wanted, kept = first_months if quarterly else set(months), {r[0] for r in fresh.select(PERIOD).distinct().collect()}
                for value in wanted - kept:
                    drop_folder(spark, f"{path}/{PERIOD}={value}")


def write_small_marts(spark: SparkSession, root: str) -> None:
    """The marts built from small tables, each as a new version of its snapshot."""
    balances = read_table(spark, TABLES["census_balance"], root)
    built = {
        "np_ratio_realtime": marts.np_ratio_of_balances(balances, read_mart(spark, root, "facility_daily_summary")),
        "dq_dashboard": marts.dq_dashboard(read_table(spark, TABLES["data_quality_results"], root)),
        "dim_facility_current": marts.current_facilities(read_snapshot(spark, TABLES["dim_facility"], root)),
    }
    for name, rows in built.items():
        write_snapshot(spark, rows, f"{root}/marts/{name}")


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored mart, in its current version."""
    if name in PERIOD_MARTS:
        return spark.read.parquet(f"{root}/marts/{name}").drop(PERIOD)
    return spark.read.parquet(snapshot_folder(spark, f"{root}/marts/{name}"))


def changed_keys(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """(work_date, facility_id, role_code) of the dated rows that ingestion batches brought."""
    rows = typed_staffing(bronze_of(spark, root, batches)).filter("work_date is not null")
    return rows.select("work_date", "facility_id", "role_code").distinct()


def run_marts(spark: SparkSession, root: str, full: bool = False) -> str:
    """Bring the stored marts up to date with the Gold tables.

    Of the marts by month or quarter, the periods of batches that Gold has taken
    in since the last run are rebuilt, or all with ``full`` and the first time.
    """

    def work(run_id: str) -> tuple[int, None]:
        require_rows(read_table(spark, TABLES["fact_staffing"], root), "NO_GOLD_DATA")
        pending = pending_batches(spark, root, batches_reached(spark, root, "gold"), "marts")
        if full or not path_exists(spark, f"{root}/marts/scorecard_quarterly"):
            write_period_marts(spark, root, None)
        elif pending:
            month = (F.year("work_date") * 100 + F.month("work_date")).cast("int")
            touched = changed_keys(spark, root, pending).select(month.alias("m")).distinct()
            write_period_marts(spark, root, sorted(r.m for r in touched.collect()))
        write_small_marts(spark, root)
        if pending:
            mark_batches(spark, root, "marts", pending, run_id)
        return 0, None

    return tracked(spark, root, "KPI_Marts", "GOLD", TABLES["fact_staffing"].full_name, work)


def run_etl(
    spark: SparkSession, landing: str, root: str, run_date: str, attributes: DataFrame | None = None
) -> dict[str, str]:
    """The batch path in order: ingestion, Silver, Gold, features."""

    def ingest(run_id: str) -> tuple[int, None]:
        return ingest_bronze(spark, landing, root, f"{root}/checkpoints/bronze"), None

    return {
        "bronze": tracked(spark, root, "Bronze_Ingestion", "BRONZE", landing, ingest),
        "silver": run_silver(spark, root),
        "gold": run_gold(spark, root, run_date, attributes),
        "features": run_features(spark, root),
        "marts": run_marts(spark, root),
    }


def run_realtime(spark: SparkSession, envelopes: DataFrame, root: str) -> str:
    """The event path in order: Bronze, Silver, census. Each is recorded as the
    batch jobs are; the first that finds nothing to do ends the path."""
    raw, silver = TABLES["adt_events_raw"], TABLES["adt_events_standardized"]
    steps = [
        ("ADT_Bronze_Streaming", "BRONZE", "adt_stream", lambda: run_bronze_events(envelopes, root, f"{root}/checkpoints/adt_bronze")),
        ("ADT_Silver_Streaming", "SILVER", raw.full_name, lambda: run_silver_events(spark, root, f"{root}/checkpoints/adt_silver")),
        ("ADT_Census_Streaming", "GOLD", silver.full_name, lambda: run_census_stream(spark, root, f"{root}/checkpoints/adt_census")),
    ]
    for name, layer, source, step in steps:
        outcome = tracked(spark, root, name, layer, source, lambda _: (step(), None))
        if outcome != "SUCCESS":
            return outcome
    return "SUCCESS"


def refresh_features(spark: SparkSession, root: str, changed: DataFrame) -> int:
    """Recompute the stored features that changed days can move; returns their number.

    The fact is read from some weeks before the earliest changed day to some
    weeks after the last one. Series whose neighbouring days lie beyond that are
    read whole.
    """
    table, fact = TABLES["overtime_features"], TABLES["fact_staffing"]
    lo, hi = (date(d // 10000, d // 100 % 100, d % 100) for d in changed.agg(F.min("date_key"), F.max("date_key")).first())
    start = ((lo - timedelta(days=7)).replace(day=1) - timedelta(days=1)).replace(day=1)
    end = ((hi + timedelta(days=40)).replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)
    months = [int(m) for m in partition_values(spark, fact.path(root), MONTH) if m.isdigit()]
    from_begin, to_end = start.year * 100 + start.month <= min(months), end.year * 100 + end.month >= max(months)
    near, whole = read_days(spark, fact, root, str(start), str(end)), read_table(spark, fact, root)
    with staged(spark, affected_ranges(near, changed, start, from_begin, to_end), "ranges") as ranges:
        far = changed.join(
            ranges.filter("not complete"), all_of([F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ("facility_id", "role_code")]), "left_semi"
        )
        rows = features_in(near, ranges.filter("complete"))
        if not ranges.filter("not complete").isEmpty():
            rows = rows.unionByName(features_in(whole, affected_ranges(whole, far, start, True, True)))
        seen = Observation()
        with staged(spark, rows.observe(seen, F.count(F.lit(1)).alias("records")), "features") as fresh:
            merge_into_version(spark, table, root, fresh)
            return seen.get["records"]


def run_features(spark: SparkSession, root: str, full: bool = False) -> str:
    """Features of what Gold has taken in since the last run: the first time, or
    with ``full``, the whole table is rebuilt as a new version."""

    def work(run_id: str) -> tuple[int, None]:
        fact = require_rows(read_table(spark, TABLES["fact_staffing"], root), "NO_GOLD_DATA")
        table = TABLES["overtime_features"]
        pending = pending_batches(spark, root, batches_reached(spark, root, "gold"), "features")
        if full or snapshot_folder(spark, table.path(root)) is None:
            seen = Observation()
            rows = overtime_features(fact).observe(seen, F.count(F.lit(1)).alias("records"))
            write_snapshot(spark, rows, table.path(root), table)
            records = seen.get["records"]
        else:
            keys = changed_keys(spark, root, pending).select(date_key("work_date").alias("date_key"), "facility_id", "role_code")
            with staged(spark, keys, "changed") as changed:
                records = 0 if changed.isEmpty() else refresh_features(spark, root, changed)
        if pending:
            mark_batches(spark, root, "features", pending, run_id)
        return records, None

    return tracked(spark, root, "ML_Feature_Pipeline", "ML", TABLES["fact_staffing"].full_name, work)
