from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.functions import cron
from wardflow.operators import control, ops
from wardflow.operators.dedup import get_watermark, newer_than
from wardflow.plans import jobs
from wardflow.schemas import TABLES, create_all_tables
from wardflow.sources import tables


def test_run_states(spark, tmp_path):
    root = str(tmp_path)
    ok = control.start_pipeline_run(spark, "Bronze_Ingestion", "BRONZE", "SNS", root)
    bad = control.start_pipeline_run(spark, "Silver", "SILVER", root=root)
    open_run = control.start_pipeline_run(spark, "Gold", "GOLD", "MANUAL", root)
    control.complete_pipeline_run(spark, ok, 10, 9, 1, datetime(2026, 1, 1), root=root)
    control.complete_pipeline_run(spark, bad, 0, 0, 0, error_message="x" * 900, root=root)
    runs = {r.run_id: r for r in control.current_runs(tables.read_table(spark, TABLES["pipeline_runs"], root)).collect()}
    assert (runs[ok].status, runs[ok].triggered_by, runs[ok].layer, runs[ok].records_written) == ("SUCCESS", "SNS", "BRONZE", 9)
    assert runs[ok].duration_seconds >= 0 and runs[ok].watermark_to == datetime(2026, 1, 1)
    assert (runs[bad].status, len(runs[bad].error_message)) == ("FAILED", 900)
    assert runs[open_run].status == "RUNNING"


def test_tracked_failure_is_recorded_and_raised(spark, tmp_path):
    root = str(tmp_path)

    def work(run_id):
        raise ValueError("broken input")

    with pytest.raises(ValueError, match="broken input"):
        jobs.tracked(spark, root, "Job", "SILVER", "src", work)
    run = control.current_runs(tables.read_table(spark, TABLES["pipeline_runs"], root)).first()
    assert (run.status, run.error_message) == ("FAILED", "broken input")
    log = tables.read_table(spark, TABLES["pipeline_log"], root).first()
    assert log.status == "FAILED"


def test_bookmark_failure_is_not_fatal(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("no folder")
    control.write_job_bookmark(spark, "job", "src", 1, root=str(blocked))


def test_bookmarks_keep_the_newest(spark, tmp_path):
    root = str(tmp_path)
    assert control.last_offset(spark, "job", "src", root) is None
    for batch in ("1", "2"):
        control.write_job_bookmark(spark, "job", "src", 5, batch, root=root)
    newest = control.current_bookmarks(tables.read_table(spark, TABLES["job_bookmark"], root)).collect()
    assert [(r.batch_id, r.record_count) for r in newest] == [("2", 5)]
    assert control.last_offset(spark, "job", "src", root) == "2"


def test_file_registration_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    args = ("abc", "landing/x.csv", "bronze/x", "FAC_1", date(2026, 1, 1), 10, 1, "run")
    assert control.register_file(spark, *args, root=root) == control.register_file(spark, *args, root=root)
    control.update_file_layer_status(spark, "abc", "silver", "TRANSFORMED", "run-2", root)
    registry = tables.read_table(spark, TABLES["file_registry"], root)
    now = control.current_files(registry).collect()
    assert [(r.bronze_status, r.silver_status, r.gold_status, r.run_id) for r in now] == [
        ("INGESTED", "TRANSFORMED", "PENDING", "run-2"),
    ]
    assert registry.count() == 2


def test_dq_result_and_schema_rows(spark, tmp_path):
    root = str(tmp_path)
    control.write_dq_results(spark, "d", 10, 9, 1, {"NULL_FACILITY_ID": 1}, "f.csv", root)
    row = tables.read_table(spark, TABLES["data_quality_results"], root).first()
    assert (row.pass_rate, row.quality_status, row.error_summary) == (90.0, "WARN", {"NULL_FACILITY_ID": 1})
    for names in (["b", "a"], ["a", "b"], ["a", "b", "c"]):
        control.write_schema_registry(spark, "d", names, root)
    assert tables.read_table(spark, TABLES["schema_registry"], root).count() == 2


def test_schedule_migration(spark):
    old = spark.createDataFrame(
        [("H1", "DAILY", 8, 2, True, None, 0), ("H2", "MONDAY", 23, 0, False, datetime(2026, 1, 1), 3)],
        "hospital_id STRING, expected_day STRING, expected_by_hour INT, grace_period_hrs INT, is_active BOOLEAN,"
        " last_received_at TIMESTAMP, consecutive_misses INT",
    )
    new = control.migrate_file_schedule(old)
    assert new.columns == TABLES["file_schedule"].struct.names
    rows = [(r.facility_id, r.file_type, r.schedule_cron, r.grace_period_minutes, r.alert_severity) for r in new.collect()]
    assert rows == [("H1", "STAFFING", "0 8 * * *", 120, "WARN"), ("H2", "STAFFING", "0 23 * * 1", 0, "WARN")]
    assert control.migrate_file_schedule(new) is new


def test_missed_files_by_walking_the_slots(spark):
    as_of = datetime(2026, 3, 2, 9, 30)
    cases = [
        (cron, grace, last)
        for cron in ("0 8 * * *", "15 23 * * *", "0 8 * * 0", "30 9 * * 1", "0 0 * * 6")
        for grace in (0, 30, 60, 1500)
        for last in (None, datetime(2026, 3, 2, 8, 0), datetime(2026, 3, 2, 7, 59), datetime(2026, 2, 10, 12, 0),
                     datetime(2026, 3, 2, 9, 30))
    ]
    ddl = ("facility_id STRING, file_type STRING, schedule_cron STRING, grace_period_minutes INT, alert_severity STRING,"
           " is_active BOOLEAN, last_received_at TIMESTAMP, consecutive_misses INT")
    df = spark.createDataFrame([(str(i), "STAFFING", c, g, "CRITICAL", True, last, 0) for i, (c, g, last) in enumerate(cases)], ddl)
    none = spark.createDataFrame([], "facility_id STRING, file_type STRING, received_at TIMESTAMP")
    got = {int(r.facility_id): r for r in control.missed_files(df, none, str(as_of), "2026-02-01 00:00:00").collect()}
    for i, (cron, grace, last) in enumerate(cases):
        minute, hour, _, _, weekday = cron.split()
        misses, day = 0, datetime(2026, 1, 25)
        while day < as_of + timedelta(days=1):
            slot = day + timedelta(hours=int(hour), minutes=int(minute))
            if weekday in ("*", str((day.weekday() + 1) % 7)):
                late = slot + timedelta(minutes=grace) < as_of
                misses += slot > (last or datetime(2026, 2, 1)) and late
            day += timedelta(days=1)
        assert got[i].consecutive_misses == misses, (cron, grace, last)
        assert got[i].severity == ("CRITICAL" if misses else None)


def test_arrivals_reset_misses_and_inactive_rows_are_left_out(spark):
    ddl = ("facility_id STRING, file_type STRING, schedule_cron STRING, grace_period_minutes INT, alert_severity STRING,"
           " is_active BOOLEAN, last_received_at TIMESTAMP, consecutive_misses INT")
    df = spark.createDataFrame(
        [("A", "STAFFING", "0 8 * * *", 0, "WARN", True, datetime(2026, 1, 1), 7),
         ("B", "STAFFING", "0 8 * * *", 0, "WARN", False, None, 7)], ddl)
    seen = spark.createDataFrame([("A", "STAFFING", datetime(2026, 1, 4, 9))], "facility_id STRING, file_type STRING, received_at TIMESTAMP")
    rows = control.missed_files(df, seen, "2026-01-05 08:00:01", "2026-01-01").collect()
    assert [(r.facility_id, r.consecutive_misses, r.last_received_at) for r in rows] == [("A", 1, datetime(2026, 1, 4, 9))]


def test_retention_and_questions(spark):
    df = spark.sql("select explode(sequence(date'2026-01-01', date'2026-01-10')) d")
    assert ops.within_retention(df, "d", "2026-01-10", 3).count() == 4
    log = spark.createDataFrame(
        [("1", "p", datetime(2026, 1, 9), "FAILED"), ("2", "p", datetime(2026, 1, 9, 5), "SUCCESS"),
         ("3", "p", datetime(2025, 12, 1), "FAILED")],
        "pipeline_id STRING, pipeline_name STRING, event_timestamp TIMESTAMP, status STRING")
    assert [r.pipeline_id for r in ops.job_status(log, "2026-01-09").collect()] == ["2"]
    assert [r.pipeline_id for r in ops.pipeline_failures(log, "2026-01-10", 7).collect()] == ["1"]


def test_all_tables_are_created_once(spark, tmp_path):
    names = create_all_tables(spark, str(tmp_path), "t_")
    assert create_all_tables(spark, str(tmp_path), "t_") == names
    assert len(names) == len(TABLES)
    assert all(spark.table(n).count() == 0 for n in names)
    assert get_watermark(spark, "t_silver.staffing_standardized") == "1970-01-01 00:00:00"
    assert get_watermark(spark, "t_silver.no_such_table") == "1970-01-01 00:00:00"
    for schema in ("bronze", "silver", "gold", "ml_ready", "batch_control"):
        spark.sql(f"DROP SCHEMA t_{schema} CASCADE")


def test_watermark_filter_is_strict_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp'2026-01-01' _ingested_at union all select timestamp'2026-01-02'").write.parquet(path)
    df = newer_than(spark.read.parquet(path), "2026-01-01 00:00:00")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at" in plan


def allowed(field, low, high, names=()):
    """The values of a cron field, read in plain Python."""
    out = set()
    for item in field.upper().split(","):
        for number, name in enumerate(names, low if low else 0):
            item = item.replace(name, str(number))
        span, _, step = item.partition("/")
        first, _, last = span.partition("-")
        first, last = (low, high) if first == "*" else (int(first), int(last or (high if step else first)))
        out |= set(range(first, last + 1, int(step or 1)))
    return out


def walked(line, after, before):
    """Slots between two moments, minute by minute."""
    minute, hour, day, month, weekday = line.split()
    minutes, hours, days = allowed(minute, 0, 59), allowed(hour, 0, 23), allowed(day, 1, 31)
    months, weekdays = allowed(month, 1, 12, cron.MONTHS), {d % 7 for d in allowed(weekday, 0, 7, cron.WEEKDAYS)}
    count, at = 0, after.replace(second=0, microsecond=0)
    while at < before:
        by_day = [at.day in days, (at.weekday() + 1) % 7 in weekdays]
        fits = any(by_day) if day[0] != "*" and weekday[0] != "*" else all(by_day)
        count += after < at and at.minute in minutes and at.hour in hours and at.month in months and fits
        at += timedelta(minutes=1)
    return count


def test_full_cron_lines_by_walking_every_minute(spark):
    lines = ["0,30 5-23 * * 1-5", "0 6 1 */3 *", "*/7 0 * * *", "10/20 8-18/5 13 * FRI", "5 4 */2 jan-apr,dec sun,sat", "0 0 31 * 7", "59 23 28-31 2 *"]
    spans = [(datetime(2025, 12, 30, 8, 30), datetime(2026, 2, 2, 6, 0)), (datetime(2026, 1, 2, 8, 10), datetime(2026, 1, 2, 18, 11, 30)), (datetime(2026, 1, 2), datetime(2026, 1, 1))]
    rows = [(line, a, b) for line in lines for a, b in spans]
    df = spark.createDataFrame(rows, "line STRING, a TIMESTAMP, b TIMESTAMP")
    got = df.select("line", "a", "b", cron.slots_between(cron.parsed(F.col("line")), F.unix_timestamp("a"), F.unix_timestamp("b")).alias("n")).collect()
    assert [(r.line, r.n) for r in got] == [(line, walked(line, a, b)) for line, a, b in rows]


@pytest.mark.parametrize("line", ["61 8 * * *", "0 24 * * *", "0 8 0 * *", "0 8 * 13 *", "0 8 * * 8", "0 8 * *", "", "x 8 * * *", "0 8-6 * * *", "*/0 8 * * *", "0 8 * * MOON", "1,,2 8 * * *"])
def test_unreadable_schedules_are_reported(spark, line):
    ddl = ("facility_id STRING, file_type STRING, schedule_cron STRING, grace_period_minutes INT, alert_severity STRING,"
           " is_active BOOLEAN, last_received_at TIMESTAMP, consecutive_misses INT")
    df = spark.createDataFrame([("A", "STAFFING", line, 0, "WARN", True, None, 4)], ddl)
    none = spark.createDataFrame([], "facility_id STRING, file_type STRING, received_at TIMESTAMP")
    row = control.missed_files(df, none, "2026-01-05 08:00:01", "2026-01-01").first()
    assert (row.consecutive_misses, row.severity) == (None, "UNREADABLE")


def test_folded_logs_keep_their_rows(spark, tmp_path, monkeypatch):
    """Readers see the same rows before, after and between folds, also of one that breaks off."""
    root, table = str(tmp_path), TABLES["pipeline_runs"]
    many = spark.range(1_000).select(
        F.concat(F.lit("old-"), F.col("id")).alias("run_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in table.struct if f.name not in ("run_id", "layer")],
        F.element_at(F.array(F.lit("BRONZE"), F.lit("GOLD")), (F.col("id") % 2 + 1).cast("int")).alias("layer"),
    )
    many.repartition(1_000, "run_id").write.partitionBy("layer").parquet(table.path(root))
    runs = lambda: sorted((r.run_id, r.status or "", r.layer) for r in tables.read_table(spark, table, root).collect())
    before = runs()
    reader = tables.read_table(spark, table, root)
    assert len(before) == 1_000 and jobs.compact_logs(spark, root)["pipeline_runs"] > 400
    assert runs() == before and reader.count() == 1_000
    assert len(tables.read_table(spark, table, root).inputFiles()) <= 8
    ok = control.start_pipeline_run(spark, "Silver", "SILVER", root=root)
    control.complete_pipeline_run(spark, ok, 1, 1, 0, root=root, layer="SILVER")
    assert len(runs()) == 1_002 and {r.status for r in control.current_runs(tables.read_table(spark, table, root)).filter(F.col("run_id") == ok).collect()} == {"SUCCESS"}
    # Broken off before its line: nothing has changed. Then before the old files go.
    seen = runs()
    with monkeypatch.context() as broken:
        broken.setattr(tables.uuid, "uuid4", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.compact_logs(spark, root)
    assert runs() == seen
    with monkeypatch.context() as broken:
        broken.setattr(tables, "drop_folder", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.compact_logs(spark, root)
    assert runs() == seen
    control.start_pipeline_run(spark, "Gold", "GOLD", root=root)
    jobs.compact_logs(spark, root)
    assert len(runs()) == 1_003 and jobs.compact_logs(spark, root)["pipeline_runs"] == 0
    assert len(tables.data_files(spark, table.path(root))) < 10


def test_days_are_walked_once_for_a_line(spark):
    lines = ["0,30 5-23 * * 1-5", "10/20 8-18/5 13 * FRI", "59 23 28-31 2 *"]
    seen = [datetime(2025, 12, 30, 8, 30), datetime(2026, 2, 2, 6, 0), datetime(2026, 3, 9, 23, 58), datetime(2026, 3, 10, 8, 10), datetime(2026, 3, 12)]
    ddl = ("facility_id STRING, file_type STRING, schedule_cron STRING, grace_period_minutes INT, alert_severity STRING,"
           " is_active BOOLEAN, last_received_at TIMESTAMP, consecutive_misses INT")
    rows = [(f"F{i}", "STAFFING", line, 0, "WARN", True, at, 0) for line in lines for i, at in enumerate(seen)]
    none = spark.createDataFrame([], "facility_id STRING, file_type STRING, received_at TIMESTAMP")
    out = control.missed_files(spark.createDataFrame(rows, ddl), none, "2026-03-10 18:11:00", "2026-01-01")
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.schedule_cron, r.last_received_at): r.consecutive_misses for r in out.collect()}
    assert got == {(r[2], r[6]): walked(r[2], r[6], datetime(2026, 3, 10, 18, 11)) for r in rows}
