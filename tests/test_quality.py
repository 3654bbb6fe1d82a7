from pyspark.sql import functions as F

from wardflow.config import STAFFING_COLUMNS
from wardflow.operators import ops, quality

GOOD = ("F", "2026-01-21", "RN", "5", "10", "40", "4", "DAY")
BAD = (None, "2026-01-21", "RN", "abc", "1600", "40", "25", "DAY")


def test_valid_and_bad_make_the_whole(staffing_frame):
    df = staffing_frame(GOOD, BAD, GOOD, ("", *GOOD[1:]))
    valid, bad = quality.split_valid(df)
    assert (valid.count(), bad.count()) == (2, 2)
    assert sorted(bad.first().reasons) == [
        "CENSUS_OUT_OF_RANGE", "NULL_FACILITY_ID", "OT_HOURS_EXCEED_MAX", "STAFF_COUNT_NOT_NUMERIC",
    ]


def test_queue_takes_a_retried_record_once(staffing_frame):
    bad = quality.split_valid(staffing_frame(BAD))[1]
    index = quality.quarantine_index(bad, ["facility_id", "staff_count"])
    assert index.first().raw_record == '{"staff_count":"abc"}'
    again = index.withColumn("ingestion_timestamp", F.lit("2027-01-01").cast("timestamp"))
    kept = quality.quarantine_queue(index.unionByName(again)).collect()
    assert len(kept) == 1 and kept[0].ingestion_timestamp.year == 2026
    other = index.withColumn("source_file", F.lit("b.csv"))
    assert quality.quarantine_queue(index.unionByName(other)).count() == 2


def test_queue_of_a_batch_moves_only_repeated_messages(staffing_frame):
    rows = [("FAC_1", "2026-01-01", "RN", str(-i), "10", "40", "4", "DAY") for i in (1, 2, 2, 3, 3, 3)]
    _, bad = quality.split_valid(staffing_frame(*rows))
    index = quality.quarantine_index(bad, STAFFING_COLUMNS)
    repeated = quality.repeated_messages(index)
    assert repeated.count() == 2
    queue = quality.queue_of_batch(index, repeated)
    whole = quality.quarantine_queue(index)
    assert queue.columns == whole.columns
    assert sorted(queue.collect()) == sorted(whole.collect()) and queue.count() == 3


def test_surplus_cells_make_a_row_bad(staffing_frame):
    rows = staffing_frame(("FAC_1", "2026-01-01", "RN", "5", "10", "40", "4", "DAY")).withColumn("_surplus", F.lit("x"))
    valid, bad = quality.split_valid(rows)
    assert valid.count() == 0 and [r.reasons for r in bad.collect()] == [["SURPLUS_CELLS"]]


def test_status_thresholds(spark):
    df = spark.createDataFrame([(10, 10, 0), (10, 9, 1), (100, 89, 11)], "total_records INT, valid_records INT, quarantined INT")
    rows = df.select(quality.pass_rate().alias("p"), quality.quality_status().alias("s")).collect()
    assert [tuple(r) for r in rows] == [(100.0, "PASS"), (90.0, "WARN"), (89.0, "FAIL")]


def test_summary_counts_rules(staffing_frame):
    judged = quality.with_reasons(staffing_frame(GOOD, BAD))
    row = quality.dq_summary(judged, ["_source_file"]).first()
    assert (row.total_records, row.valid_records, row.quarantined, row.quality_status) == (2, 1, 1, "FAIL")
    assert row.error_summary == {
        "NULL_FACILITY_ID": 1, "CENSUS_OUT_OF_RANGE": 1, "OT_HOURS_EXCEED_MAX": 1, "STAFF_COUNT_NOT_NUMERIC": 1,
    }


def test_schema_version_ignores_order_and_registers_once(spark):
    df = spark.createDataFrame(
        [("d", ["b", "a"], "2026-01-01"), ("d", ["a", "b"], "2026-01-02"), ("d", ["a", "b", "c"], "2026-01-03")],
        "dataset_name STRING, columns ARRAY<STRING>, t STRING",
    ).withColumn("seen_at", F.col("t").cast("timestamp"))
    registry = quality.new_schema_versions(df)
    assert registry.count() == 2
    assert quality.new_schema_versions(df, registry).isEmpty()
    assert all(r.schema_version.startswith("v_") and len(r.schema_version) == 10 for r in registry.collect())
    drift = quality.schema_drift(registry).collect()
    assert [(r.dataset_name, r.versions, r.drifted_columns) for r in drift] == [("d", 2, ["c"])]


def test_remediation_marks_only_the_fixed(staffing_frame):
    bad = quality.split_valid(staffing_frame(BAD, ("", *GOOD[1:])))[1]
    index = quality.quarantine_index(bad, ["facility_id", "staff_count"])
    fixed = index.filter("facility_id is null")
    after = quality.resolve_remediated(index, fixed, ["source_file", "record_hash"])
    assert {r.facility_id: r.resolved for r in after.collect()} == {None: True, "": False}
    assert ops.quarantine_unresolved(after).count() == 1
    twice = quality.resolve_remediated(after, fixed, ["source_file", "record_hash"])
    assert sorted(r.resolved for r in twice.collect()) == [False, True]
