from datetime import date

import pytest

from wardflow.operators import scd2
from wardflow.plans import jobs
from wardflow.schemas import TABLES
from wardflow.sources import tables

FIRST = [("FAC_0", 100, 0.20), ("FAC_1", 150, 0.25), ("FAC_2", 200, 0.25), ("FAC_3", 250, 0.30), ("FAC_4", 300, 0.30)]
SECOND = [("FAC_0", 100, 0.20), ("FAC_1", 175, 0.25), ("FAC_2", 200, 0.25), ("FAC_3", 250, 0.35), ("FAC_4", 300, 0.30),
          ("FAC_5", 120, 0.25)]


@pytest.fixture
def snapshots(spark):
    ddl = "facility_id STRING, bed_capacity INT, staffing_benchmark DOUBLE"
    return spark.createDataFrame(FIRST, ddl), spark.createDataFrame(SECOND, ddl)


def check_versions(dim):
    """At most one current row per facility, and no overlapping ranges."""
    by_id = {}
    for r in dim.collect():
        by_id.setdefault(r.facility_id, []).append(r)
    for rows in by_id.values():
        rows.sort(key=lambda r: r.effective_from)
        assert [r.is_current for r in rows] == [False] * (len(rows) - 1) + [True]
        for old, new in zip(rows, rows[1:]):
            assert old.effective_to == new.effective_from
        assert rows[-1].effective_to is None
    return by_id


def test_two_snapshots(spark, snapshots):
    one, two = snapshots
    dim = scd2.first_load(one, "2024-01-01")
    after = scd2.apply_changes(dim, two, "2024-02-01")
    by_id = check_versions(after)
    assert sum(len(v) for v in by_id.values()) == 8
    assert after.filter("is_current").count() == 6
    assert [r.bed_capacity for r in by_id["FAC_1"]] == [150, 175]
    audit = {r.facility_id: r for r in scd2.audit_rows(two, dim, "2024-02-01").collect()}
    assert sorted(audit) == ["FAC_1", "FAC_3"]
    assert audit["FAC_3"].old_values["staffing_benchmark"] == "0.3"
    assert audit["FAC_3"].new_values["staffing_benchmark"] == "0.35"


def test_same_source_again_changes_nothing(snapshots):
    one, two = snapshots
    after = scd2.apply_changes(scd2.first_load(one, "2024-01-01"), two, "2024-02-01")
    for day in ("2024-02-01", "2024-03-01"):
        again = scd2.apply_changes(after, two, day)
        assert again.exceptAll(after).isEmpty() and after.exceptAll(again).isEmpty()


def test_missing_attributes_are_no_change(spark, snapshots):
    one, _ = snapshots
    dim = scd2.first_load(one, "2024-01-01")
    ids = spark.createDataFrame([("FAC_0", None, None), ("FAC_9", None, None)], one.schema)
    after = scd2.apply_changes(dim, ids, "2024-02-01")
    assert after.count() == 6
    partly = spark.createDataFrame([("FAC_0", 101, None)], one.schema)
    newest = scd2.apply_changes(dim, partly, "2024-02-01").filter("facility_id = 'FAC_0' and is_current").first()
    assert (newest.bed_capacity, newest.staffing_benchmark) == (101, 0.20)


def test_stored_dimension_and_audit(spark, tmp_path, snapshots):
    root = str(tmp_path)
    for source, day in zip((*snapshots, snapshots[1]), ("2024-01-01", "2024-02-01", "2024-02-01")):
        jobs.run_dimension(spark, root, source, day)
    dim = tables.read_snapshot(spark, TABLES["dim_facility"], root)
    assert sum(len(v) for v in check_versions(dim).values()) == 8
    assert dim.select("facility_key").distinct().count() == 8
    audit = tables.read_table(spark, TABLES["scd2_audit"], root)
    assert {(r.facility_id, r.changed_on) for r in audit.collect()} == {
        ("FAC_1", date(2024, 2, 1)), ("FAC_3", date(2024, 2, 1)),
    }
    assert audit.count() == 2


def test_ids_of_several_sources(spark):
    a = spark.createDataFrame([("A",), ("A",), (None,)], "facility_id STRING")
    b = spark.createDataFrame([("A",), ("B",)], "facility_id STRING")
    assert sorted(r[0] for r in scd2.known_facilities(a, b).collect()) == ["A", "B"]
