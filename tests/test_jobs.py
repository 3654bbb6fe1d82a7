"""Files to features, and events to census, over stored tables."""

import json
import os
import time
from base64 import b64encode
from contextlib import contextmanager
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardflow.__main__ import NAMES, ask
from wardflow.operators import control
from wardflow.plans import jobs
from wardflow.schemas import TABLES
from wardflow.sources import tables
from wardflow.streaming import adt as streams
from wardflow.streaming import ingest

HEADER = "facility_id,work_date,role_code,staff_count,patient_census,hours_worked,hours_worked_overtime,shift_type\n"


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        root = str(tmp_path / "lake")
        landing = tmp_path / "landing"

        def drop(self, name, text):
            path = self.landing / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)

        def ingest(self, checkpoint="bronze", **options):
            ingest.ingest_bronze(spark, str(self.landing), self.root, f"{tmp_path}/checkpoints/{checkpoint}", **options)

        def read(self, name):
            return tables.read_table(spark, TABLES[name], self.root)

    return Lake()


def test_ingestion_is_incremental_and_complete(spark, lake):
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,5,10,40,4,DAY\n,2026-01-01,RN,x,10,40,4,DAY\n")
    lake.ingest()
    lake.ingest()
    assert ingest.read_bronze(spark, lake.root).count() == 1
    assert lake.read("quarantine_index").first().quarantine_reason == ["NULL_FACILITY_ID", "STAFF_COUNT_NOT_NUMERIC"]

    lake.drop("FAC_2/b.csv", "agency_hours," + HEADER + "3,FAC_2,01/02/2026,RN,5,10,40,4,DAY\n")
    lake.drop("FAC_2/empty.csv", HEADER)
    lake.drop("FAC_1/a_again.csv", (lake.landing / "FAC_1/a.csv").read_text())
    lake.ingest()
    rows = {r.facility_id: r for r in ingest.read_bronze(spark, lake.root).collect()}
    assert (rows["FAC_1"].agency_hours, rows["FAC_2"].agency_hours) == (None, "3")
    assert len({r._record_index for r in rows.values()}) == 2
    assert rows["FAC_2"]._source_file.endswith("FAC_2/b.csv")

    assert lake.read("ingestion_ledger").count() == 3
    assert lake.read("schema_registry").count() == 2
    results = {r.source_file.rsplit("/", 1)[-1]: r for r in lake.read("data_quality_results").collect()}
    assert (results["a.csv"].quality_status, results["b.csv"].quality_status) == ("FAIL", "PASS")
    assert (results["empty.csv"].total_records, results["empty.csv"].pass_rate) == (0, None)
    files = control.current_files(lake.read("file_registry")).collect()
    assert {r.hospital_id for r in files} == {"FAC_1", "FAC_2"}
    audit = spark.read.json(f"{lake.root}/audit/ingestion")
    assert audit.count() == 3


def test_several_micro_batches_give_the_same_bronze(spark, lake):
    for i in range(5):
        lake.drop(f"FAC_{i}/a.csv", HEADER + f"FAC_{i},2026-01-01,RN,5,10,40,4,DAY\n")
    lake.ingest(max_files=2)
    assert ingest.read_bronze(spark, lake.root).select("facility_id").distinct().count() == 5
    assert ingest.read_bronze(spark, lake.root).count() == 5


def test_bad_header_and_long_rows_do_not_stop_a_batch(spark, lake):
    good = "FAC_1,2026-01-01,RN,5,10,40,4,DAY"
    lake.drop("FAC_1/a.csv", HEADER + good + "\n" + good + ",more\n")
    lake.drop("FAC_2/twice.csv", "facility_id,Facility_ID\nFAC_2,FAC_2\n")
    lake.drop("FAC_3/b.csv", HEADER.upper() + good.replace("FAC_1", "FAC_3") + "\n")
    lake.ingest()
    lake.ingest()
    assert sorted(r.facility_id for r in ingest.read_bronze(spark, lake.root).collect()) == ["FAC_1", "FAC_3"]
    bad = {r.source_file.rsplit("/", 1)[-1]: r for r in lake.read("quarantine_index").collect()}
    assert bad["a.csv"].quarantine_reason == ["SURPLUS_CELLS"] and "more" in bad["a.csv"].raw_record
    assert bad["twice.csv"].quarantine_reason == ["HEADER_NOT_READABLE"] and "facility_id" in bad["twice.csv"].raw_record
    results = {r.source_file.rsplit("/", 1)[-1]: r for r in lake.read("data_quality_results").collect()}
    assert results["twice.csv"].quality_status == "FAIL" and results["a.csv"].error_summary == {"SURPLUS_CELLS": 1}
    assert lake.read("ingestion_ledger").count() == 3


def test_retried_batch_and_lost_checkpoint_add_nothing(spark, lake):
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,5,10,40,4,DAY\n")
    paths = [str(lake.landing / "FAC_1/a.csv")]
    for _ in range(2):
        ingest.ingest_files(spark, paths, lake.root, "d", "batch-1", "2026-01-01 00:00:00")
    lake.ingest("another")
    assert ingest.read_bronze(spark, lake.root).count() == 1
    assert lake.read("ingestion_ledger").count() == 1


def test_valid_rows_are_written_once_and_nothing_wide_is_sorted(spark, lake, monkeypatch):
    kept, moved = {}, []
    real_staged, real_queue = ingest.staged, ingest.queue_of_batch

    @contextmanager
    def watched(session, df, label):
        with real_staged(session, df, label) as rows:
            kept[label] = rows.count()
            yield rows

    def watched_queue(index, repeated):
        moved.append(repeated.count())
        return real_queue(index, repeated)

    monkeypatch.setattr(ingest, "staged", watched)
    monkeypatch.setattr(ingest, "queue_of_batch", watched_queue)
    good, bad = "FAC_1,2026-01-01,RN,5,10,40,4,DAY\n", "FAC_1,2026-01-01,RN,-5,10,40,4,DAY\n"
    lake.drop("FAC_1/a.csv", HEADER + good * 3 + bad * 2 + bad.replace("-5", "-6"))
    lake.ingest()
    assert ingest.read_bronze(spark, lake.root).count() == 3
    assert kept["lines"] == 7 and kept["bad"] == 3 and moved == [1]
    assert max(n for label, n in kept.items() if label not in ("lines", "bad")) == 1
    assert lake.read("quarantine_index").count() == 3
    assert spark.read.parquet(f"{lake.root}/quarantine/queue").count() == 2
    results = lake.read("data_quality_results").first()
    assert (results.total_records, results.valid_records, results.quarantined) == (6, 3, 3)


def test_batch_that_failed_before_the_ledger_is_redone(spark, lake, monkeypatch):
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,5,10,40,4,DAY\nFAC_1,2026-01-01,RN,-5,10,40,4,DAY\n")
    real = ingest._write_control
    monkeypatch.setattr(ingest, "_write_control", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        lake.ingest()
    monkeypatch.setattr(ingest, "_write_control", real)
    lake.ingest()
    assert ingest.read_bronze(spark, lake.root).count() == 1
    assert lake.read("quarantine_index").count() == 1
    assert lake.read("ingestion_ledger").count() == 1


def test_files_to_features(spark, lake):
    assert jobs.run_silver(spark, lake.root) == "NO_NEW_RECORDS"
    assert jobs.run_gold(spark, lake.root, "2026-01-01") == "NO_NEW_RECORDS"
    assert jobs.run_features(spark, lake.root) == "NO_GOLD_DATA"

    days = "".join(f"FAC_1,2026-01-{d:02d},RN,{d},100,40,{d % 3},DAY\n" for d in range(1, 9))
    lake.drop("FAC_1/a.csv", HEADER + days + "FAC_1,01/01/2026,RN,9,100,40,6,NIGHT\nFAC_1,junk,RN,1,10,40,4,DAY\n")
    lake.ingest()
    attributes = spark.createDataFrame([("FAC_1", 100, 0.25)], "facility_id STRING, bed_capacity INT, staffing_benchmark DOUBLE")
    assert jobs.run_silver(spark, lake.root) == "SUCCESS"
    assert jobs.run_silver(spark, lake.root) == "NO_NEW_RECORDS"
    assert jobs.run_gold(spark, lake.root, "2026-01-10", attributes) == "SUCCESS"
    assert jobs.run_gold(spark, lake.root, "2026-01-10", attributes) == "NO_NEW_RECORDS"
    assert jobs.run_features(spark, lake.root) == "SUCCESS"
    assert lake.read("staffing_standardized").count() == 9  # eight days and the undated row
    assert lake.read("fact_staffing").count() == 8
    overtime = {(r.work_date.day, r.shift_type): r.hours_overtime for r in lake.read("fact_overtime").collect()}
    assert overtime[(1, "NIGHT")] == 6.0 and overtime[(1, "DAY")] == 1.0 and (3, "DAY") not in overtime
    features = tables.read_snapshot(spark, TABLES["overtime_features"], lake.root)
    assert features.count() == 8
    assert tables.read_snapshot(spark, TABLES["dim_facility"], lake.root).first().bed_capacity == 100

    # A correction: day 2 has other staff, and its overtime is withdrawn.
    lake.drop("FAC_1/fix.csv", HEADER + "FAC_1,01/02/2026,RN,77,100,40,0,DAY\n")
    lake.ingest()
    jobs.run_silver(spark, lake.root)
    jobs.run_gold(spark, lake.root, "2026-01-11", attributes)
    fact = {r.work_date: r.staff_count for r in lake.read("fact_staffing").collect()}
    assert fact[date(2026, 1, 2)] == 77 and len(fact) == 8
    assert lake.read("fact_overtime").filter("work_date = '2026-01-02'").isEmpty()
    assert tables.read_snapshot(spark, TABLES["dim_facility"], lake.root).count() == 1

    assert jobs.run_features(spark, lake.root) == "SUCCESS"
    from wardflow.operators.features import overtime_features

    now = tables.read_snapshot(spark, TABLES["overtime_features"], lake.root)
    assert now.exceptAll(overtime_features(lake.read("fact_staffing"))).isEmpty() and now.count() == 8

    files = control.current_files(lake.read("file_registry")).collect()
    assert {(r.silver_status, r.gold_status) for r in files} == {("TRANSFORMED", "AGGREGATED")}
    runs = control.current_runs(lake.read("pipeline_runs")).collect()
    assert {r.status for r in runs} == {"SUCCESS"}


def envelope(i, payload=None, data=None):
    text = data or b64encode(json.dumps(payload).encode()).decode()
    return json.dumps({"partitionKey": f"shard-{i % 2}", "sequenceNumber": f"{i:06d}",
                       "approximateArrivalTimestamp": f"2026-01-01T0{i % 10}:00:00.000Z", "data": text}) + "\n"


def admit(i, hour, kind="A", facility="FAC_1"):
    return envelope(i, {"event_type": kind, "facility_id": facility, "unit_id": "U1", "patient_id": f"P{i % 100}",
                        "event_timestamp": f"2026-01-01T{hour:02d}:10:00Z", "bed_id": "B", "attending_role": "RN"})


@pytest.mark.parametrize("drop_replays", [False, True])
def test_event_streams(spark, tmp_path, drop_replays):
    root, source = str(tmp_path / "lake"), tmp_path / "stream"
    source.mkdir()
    with pytest.raises(tables.NothingToDo, match="NO_BRONZE_DATA"):
        streams.run_silver_events(spark, root, f"{root}/ck/silver", drop_replays)

    def run():
        streams.run_bronze_events(streams.file_envelopes(spark, str(source)), root, f"{root}/ck/bronze")
        streams.run_silver_events(spark, root, f"{root}/ck/silver", drop_replays)
        streams.run_census_stream(spark, root, f"{root}/ck/census")

    first = admit(1, 5) + admit(2, 6) + admit(3, 7, "D") + envelope(4, data="!!") + envelope(5, {"facility_id": "F"})
    (source / "a.json").write_text(first)
    run()
    bronze = tables.read_table(spark, TABLES["adt_events_raw"], root)
    assert bronze.count() == 3
    assert all(len(r.patient_id) == 64 for r in bronze.collect())
    # Replayed envelopes, one event that is late, one that is months old, and
    # one without a time that comes twice.
    old = envelope(7, {"event_type": "A", "facility_id": "FAC_1", "unit_id": "U9", "patient_id": "P", "event_timestamp": "2025-06-01T01:00:00Z"})
    undated = envelope(8, {"event_type": "A", "facility_id": "FAC_1", "unit_id": "U1", "patient_id": "P", "event_timestamp": "?"})
    (source / "b.json").write_text(admit(1, 5) + admit(2, 6) + admit(6, 6) + old + undated + undated)
    run()
    run()
    silver = tables.read_table(spark, TABLES["adt_events_standardized"], root)
    assert silver.count() == (6 if drop_replays else 9)
    assert silver.filter("event_date is null").count() == (1 if drop_replays else 2)
    with pytest.raises(ValueError, match="drop_replays"):
        streams.run_silver_events(spark, root, f"{root}/ck/other", not drop_replays)
    census = tables.read_table(spark, TABLES["fact_census_realtime"], root).orderBy("event_hour").collect()
    assert [(r.event_hour, r.census, r.admits, r.discharges) for r in census if r.unit_id == "U1"] == [(5, 1, 1, 0), (6, 3, 2, 0), (7, 2, 0, 1)]


def test_validated_events_fan_out(spark, tmp_path):
    root, source = str(tmp_path / "lake"), tmp_path / "stream"
    source.mkdir()
    lines = [admit(1, 5), admit(2, 6, facility=""), envelope(3, data="!!"), envelope(4, {"facility_id": "F"})]
    (source / "a.json").write_text("".join(lines))
    for _ in range(2):
        streams.run_validated_events(spark, streams.file_envelopes(spark, str(source)), root, f"{root}/ck")
    assert spark.read.json(f"{root}/bronze/realtime_json").count() == 1
    index = tables.read_table(spark, TABLES["quarantine_index"], root)
    assert sorted(r.quarantine_reason[0] for r in index.collect()) == [
        "EVENT_NOT_READABLE", "EVENT_NOT_READABLE", "NULL_FACILITY_ID",
    ]
    audit = spark.read.json(f"{root}/audit/realtime").agg(F.sum("total_records"), F.sum("quarantined")).first()
    assert tuple(audit) == (4, 3)


def test_kafka_records_map_to_envelopes(spark):
    raw = spark.sql("select 't' topic, 3 partition, 42L offset, timestamp'2026-01-01' timestamp, cast('x' as binary) value")
    row = streams.envelope_of_kafka(raw).first()
    assert (row.partitionKey, row.sequenceNumber, row.data) == ("t-3", "42", "x")


def test_etl_in_order_and_the_questions_about_it(spark, lake):
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,5,10,40,4,DAY\nFAC_1,2026-01-01,RN,x,10,40,4,DAY\n")
    etl = jobs.run_etl(spark, str(lake.landing), lake.root, "2026-01-02")
    assert etl == {"bronze": "SUCCESS", "silver": "SUCCESS", "gold": "SUCCESS", "features": "SUCCESS", "marts": "SUCCESS"}
    assert jobs.read_mart(spark, lake.root, "facility_daily_summary").count() == 1
    (bad,) = ask(spark, lake.root, "quarantine_unresolved").collect()
    options = {"file": bad.source_file, "facility": "FAC_1", "checksum": lake.read("ingestion_ledger").first().file_checksum}
    answers = {name: ask(spark, lake.root, name, **options).collect() for name in NAMES}
    checks = {r.check_name: r.value for r in answers["all"]}
    assert (checks["files_ingested"], checks["quarantine_unresolved"], checks["dq_fail_runs"]) == (1, 1, 1)
    assert {r.alert for r in answers["alerts"]} == {"DQ_PASS_RATE"}
    assert [(r.rule, r.records) for r in answers["quarantine_by_rule"]] == [("STAFF_COUNT_NOT_NUMERIC", 1)]
    for name in ("duplicate_check", "files_with_quarantine", "quarantine_by_file", "quarantine_of_facility", "dq_trend"):
        assert len(answers[name]) == 1, name
    assert len(answers["job_status"]) == len(answers["pipeline_runs"]) == 5
    assert answers["schema_drift"] == answers["pipeline_failures"] == []
    assert ask(spark, lake.root, "duplicate_check", file=f"{lake.landing}/FAC_1/a.csv").count() == 1
    assert [(r.added, r.missing) for r in answers["schema_changes"]] == [([], [])]

    index = lake.read("quarantine_index")
    for _ in range(2):
        jobs.mark_resolved(spark, lake.root, index, "fix-1")
    assert ask(spark, lake.root, "quarantine_unresolved").isEmpty()
    assert jobs.read_quarantine(spark, lake.root).count() == 1


def test_control_tables_are_seeded_once(spark, lake):
    facilities = spark.createDataFrame([(f"FAC_{i}",) for i in range(5)], "facility_id STRING")
    for _ in range(2):
        counts = jobs.init_control(spark, lake.root, facilities, "seed_")
        assert counts["file_schedule"] == 15
        assert sum(n for name, n in counts.items() if name != "file_schedule") == 0
    for schema in ("bronze", "silver", "gold", "ml_ready", "batch_control"):
        spark.sql(f"DROP SCHEMA seed_{schema} CASCADE")


def test_stored_schedule_is_migrated_with_a_backup(spark, lake, tmp_path):
    old = spark.sql("select 'H' hospital_id, 'DAILY' expected_day, 8 expected_by_hour, 2 grace_period_hrs, true is_active,"
                    " cast(null as timestamp) last_received_at, 0 consecutive_misses")
    old.write.parquet(f"{tmp_path}/old")
    assert jobs.run_schedule_migration(spark, f"{tmp_path}/old", f"{tmp_path}/backup", lake.root) == "MIGRATED"
    row = tables.read_snapshot(spark, TABLES["file_schedule"], lake.root).first()
    assert (row.facility_id, row.schedule_cron, row.grace_period_minutes) == ("H", "0 8 * * *", 120)
    assert spark.read.parquet(f"{tmp_path}/backup").count() == 1
    folder = tables.snapshot_folder(spark, TABLES["file_schedule"].path(lake.root))
    assert jobs.run_schedule_migration(spark, folder, f"{tmp_path}/b2", lake.root) == "ALREADY_MIGRATED"


def test_realtime_path(spark, tmp_path):
    source = tmp_path / "stream"
    source.mkdir()
    (source / "a.json").write_text(envelope(1, data="!!"))
    root = str(tmp_path / "lake")
    assert jobs.run_realtime(spark, streams.file_envelopes(spark, str(source)), root) == "NO_BRONZE_DATA"
    (source / "b.json").write_text(admit(2, 5))
    assert jobs.run_realtime(spark, streams.file_envelopes(spark, str(source)), root) == "SUCCESS"
    assert jobs.run_gold(spark, root, "2026-01-02") == "SUCCESS"
    assert tables.read_table(spark, TABLES["fact_census_realtime"], root).first().census == 1
    assert tables.read_snapshot(spark, TABLES["dim_facility"], root).first().facility_id == "FAC_1"


def test_retention_drops_months_and_the_days_before_the_limit(spark, tmp_path):
    root, table = str(tmp_path), TABLES["fact_overtime"]
    days = [20181201, 20190102, 20190109, 20190111, 20190301]
    rows = spark.createDataFrame([(d, "F", "RN", "DAY", None, 1.0, 1.0, 1.0, 1.0) for d in days], table.struct)
    tables.write_table(rows, table, root)
    kept = list((tmp_path / "gold/fact_overtime/month_key=201903").glob("*.parquet"))
    for _ in range(2):
        jobs.run_retention(spark, root, "2026-01-07")  # Gold keeps 2,555 days: from 2019-01-09 on
        assert sorted(r.date_key for r in tables.read_table(spark, table, root).collect()) == days[2:]
    assert list((tmp_path / "gold/fact_overtime/month_key=201903").glob("*.parquet")) == kept
    assert jobs.run_retention(spark, root, "2026-02-20") == [f"{root}/gold/fact_overtime/month_key=201901"]


def test_marts_of_untouched_months_are_not_rewritten(spark, lake):
    rows = "".join(f"FAC_1,2026-{m:02d}-05,RN,5,10,40,4,DAY\n" for m in (1, 2, 4))
    lake.drop("FAC_1/a.csv", HEADER + rows)
    jobs.run_etl(spark, str(lake.landing), lake.root, "2026-05-01")
    marts = Path(lake.root) / "marts"
    files = lambda: {(p.parent.parent.name, p.parent.name): p.name for p in marts.glob("*/period=*/*.parquet")}
    before = files()
    # Overtime of February is withdrawn: its month leaves the overtime mart.
    lake.drop("FAC_1/fix.csv", HEADER + "FAC_1,02/05/2026,RN,7,10,40,0,DAY\n")
    jobs.run_etl(spark, str(lake.landing), lake.root, "2026-05-02")
    after = files()
    moved = {k for k in before if before[k] != after.get(k)}
    assert moved == {("facility_daily_summary", "period=202602"), ("ot_summary_monthly", "period=202602"), ("scorecard_quarterly", "period=202601")}
    assert ("ot_summary_monthly", "period=202602") not in after
    got = {str(r.month): r.overtime_hours for r in jobs.read_mart(spark, lake.root, "ot_summary_monthly").collect()}
    assert got == {"2026-01-01": 4.0, "2026-04-01": 4.0}


def test_retention_of_landing_quarantine_and_log(spark, lake):
    """Files by when they were written, batches and log files by their newest row."""
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,x,10,40,4,DAY\n")
    lake.ingest()
    lake.drop("FAC_1/b.csv", HEADER + "FAC_1,2026-01-02,RN,y,10,40,4,DAY\n")
    old = date.today() - timedelta(days=100)
    os.utime(lake.landing / "FAC_1/a.csv", (time.mktime(old.timetuple()),) * 2)
    control.write_pipeline_log(spark, "p", 1, root=lake.root)
    today = str(date.today())
    assert [d.rsplit("/", 1)[-1] for d in jobs.run_retention(spark, lake.root, today, str(lake.landing))] == ["pipeline_log", "a.csv"]
    assert jobs.run_retention(spark, lake.root, today, str(lake.landing)) == []
    assert lake.read("quarantine_index").count() == 1 and lake.read("pipeline_log").count() == 1
    jobs.run_retention(spark, lake.root, str(date.today() + timedelta(days=95)))
    assert lake.read("quarantine_index").count() == 1 and lake.read("pipeline_log").count() == 0
    jobs.run_retention(spark, lake.root, str(date.today() + timedelta(days=185)))
    assert lake.read("quarantine_index").count() == 0


def test_corrections_resolve_what_they_put_right(spark, lake):
    lake.drop("FAC_1/a.csv", HEADER + "FAC_1,2026-01-01,RN,x,10,40,4,DAY\nFAC_1,2026-01-01,RN,x,10,40,4,NIGHT\n,2026-01-01,RN,5,10,40,4,DAY\nFAC_1,junk,RN,x,10,40,4,DAY\n")
    lake.ingest()
    state = lambda: sorted((r.quarantine_reason[0], json.loads(r.raw_record).get("shift_type"), r.resolved) for r in jobs.read_quarantine(spark, lake.root).collect())
    assert not any(r[2] for r in state())
    # The date is spelled otherwise, the shift in other letters; the night shift is still wrong.
    lake.drop("FAC_1/fix.csv", HEADER + "FAC_1,01/01/2026,RN,5,10,40,4, day \nFAC_1,01/01/2026,RN,-5,10,40,4,NIGHT\n")
    lake.ingest()
    assert [r for r in state() if r[2]] == [("STAFF_COUNT_NOT_NUMERIC", "DAY", True)]
    assert len(state()) == 5
