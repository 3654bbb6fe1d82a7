from datetime import date

import pytest
from pyspark.sql import functions as F

from wardflow.operators import facts, upsert
from wardflow.plans import jobs
from wardflow.schemas import TABLES
from wardflow.sources import tables

SILVER = TABLES["staffing_standardized"]


def staff(day, count, facility="F", role="RN"):
    return (facility, day, role, str(count), "10", "40", "4", "DAY")


def stored(spark, root):
    rows = tables.read_table(spark, SILVER, root).collect()
    return {(r.facility_id, r.work_date): r.staff_count for r in rows}


def test_update_insert_and_repeat(spark, tmp_path, staffing_frame):
    root = str(tmp_path)
    first = facts.silver_staffing(staffing_frame(staff("2026-01-01", 1), staff("2026-01-02", 2), staff("junk", 9)))
    upsert.upsert_table(spark, SILVER, root, first)
    second = facts.silver_staffing(
        staffing_frame(staff("2026-01-02", 22), staff("2026-01-03", 3), staff("junk", 99), ingested="2026-02-01")
    )
    for _ in range(2):
        upsert.upsert_table(spark, SILVER, root, second)
        assert stored(spark, root) == {
            ("F", date(2026, 1, 1)): 1, ("F", date(2026, 1, 2)): 22, ("F", date(2026, 1, 3)): 3, ("F", None): 99,
        }


def test_other_rows_of_a_touched_partition_survive(spark, tmp_path, staffing_frame):
    root = str(tmp_path)
    upsert.upsert_table(spark, SILVER, root, facts.silver_staffing(
        staffing_frame(staff("2026-01-01", 1, "A"), staff("2026-01-01", 2, None), staff("2026-01-01", 3, "C"))))
    upsert.upsert_table(spark, SILVER, root, facts.silver_staffing(
        staffing_frame(staff("2026-01-01", 20, None), ingested="2026-02-01")))
    assert {k[0]: v for k, v in stored(spark, root).items()} == {"A": 1, None: 20, "C": 3}


def test_untouched_partitions_are_not_rewritten(spark, tmp_path, staffing_frame):
    root = str(tmp_path)
    upsert.upsert_table(spark, SILVER, root, facts.silver_staffing(
        staffing_frame(staff("2026-01-01", 1), staff("2026-01-02", 2))))
    kept = list((tmp_path / "silver/staffing_standardized/month_key=202601").glob("*.parquet"))
    upsert.upsert_table(spark, SILVER, root, facts.silver_staffing(staffing_frame(staff("2026-02-02", 3))))
    assert list((tmp_path / "silver/staffing_standardized/month_key=202601").glob("*.parquet")) == kept
    assert len(list((tmp_path / "silver/staffing_standardized").glob("month_key=*"))) == 2


def month_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_of_a_month_folder_are_skipped(spark, tmp_path, staffing_frame):
    """A day predicate names the months in the partition filter and the days in the pushed one."""
    root = str(tmp_path)
    days = [f"2026-{m:02}-{d:02}" for m in (1, 2, 3) for d in (1, 9, 28)]
    rows = facts.silver_staffing(staffing_frame(*[staff(d, 1) for d in days], staff("junk", 9)))
    upsert.upsert_table(spark, SILVER, root, rows)
    hit = tables.read_days(spark, SILVER, root, "2026-01-09", "2026-02-08")
    assert sorted(str(r.work_date) for r in hit.collect()) == ["2026-01-09", "2026-01-28", "2026-02-01"]
    plan = month_plan(hit)
    assert "month_key" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(work_date" in plan and hit.columns == SILVER.struct.names
    fact = TABLES["fact_staffing"]
    upsert.upsert_table(spark, fact, root, facts.fact_staffing(rows))
    batch = facts.fact_staffing(facts.silver_staffing(staffing_frame(staff("2026-02-09", 5))))
    day = upsert.touched_days(spark, fact, root, batch)
    assert [r.date_key for r in day.collect()] == [20260209] and day.columns == fact.struct.names
    plan = month_plan(day)
    assert "month_key" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [In(date_key, [20260209])]" in plan or "EqualTo(date_key,20260209)" in plan
    assert sorted(r.month_key for r in upsert.touched_folders(spark, fact, root, batch).collect()) == [202602] * 3


def test_files_hold_days_in_order(spark, tmp_path):
    """So that the statistics of a file's parts tell its days apart."""
    table, root = TABLES["fact_overtime"], str(tmp_path)
    rows = spark.range(5_000).select(
        (F.lit(20260100) + F.col("id") % 28 + 1).cast("int").alias("date_key"), F.concat(F.lit("F"), F.col("id")).alias("facility_id"),
        F.lit("RN").alias("role_code"), F.lit("DAY").alias("shift_type"), F.lit(None).cast("date").alias("work_date"),
        *[F.lit(1.0).alias(c) for c in ("hours_worked", "hours_overtime", "overtime_pct", "overtime_cost_est")],
    )
    tables.write_table(rows.repartition(7), table, root)
    assert [p.name for p in (tmp_path / "gold/fact_overtime").glob("month_key=*")] == ["month_key=202601"]
    for file in (tmp_path / "gold/fact_overtime").rglob("*.parquet"):
        days = [r.date_key for r in spark.read.parquet(str(file)).select("date_key").collect()]
        assert days == sorted(days)


@pytest.mark.parametrize("days", [3, 5000])
def test_touched_partitions_are_pruned_at_any_width(spark, tmp_path, days):
    rows = spark.range(days + 2).select(F.date_add(F.lit("2001-01-01"), F.col("id").cast("int")).alias("work_date"), "id")
    rows.filter("id < 20").union(spark.sql("select cast(null as date), 99L")).write.partitionBy("work_date").parquet(str(tmp_path / "t"))
    stored = spark.read.schema("id BIGINT, work_date DATE").parquet(str(tmp_path / "t"))
    batch = rows.filter(F.col("id") > 1).union(spark.sql("select cast(null as date), 1L"))
    hit = upsert.touched_slice(stored, batch, "work_date")
    assert sorted(r.id for r in hit.collect()) == [*range(2, min(days + 2, 20)), 99]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "Join" not in plan


def test_duplicate_batch_keys_are_refused(spark, tmp_path, staffing_frame):
    rows = facts.typed_staffing(staffing_frame(staff("2026-01-01", 1), staff("01/01/2026", 2)))
    with pytest.raises(ValueError, match="staffing_id"):
        upsert.upsert_table(spark, SILVER, str(tmp_path), rows)


def test_latest_row_wins_with_a_total_order(staffing_frame):
    old = staffing_frame(staff("2026-01-01", 1))
    new = staffing_frame(staff("01/01/2026", 2), staff("20260101", 3), ingested="2026-01-02")
    both = facts.silver_staffing(old.unionByName(new)).collect()
    again = facts.silver_staffing(new.unionByName(old).repartition(3)).collect()
    assert len(both) == 1 and both[0].staff_count in (2, 3) and both[0].staff_count == again[0].staff_count


def test_both_shifts_of_a_day_reach_overtime(staffing_frame):
    rows = staffing_frame(
        ("F", "2026-01-01", "RN", "5", "10", "40", "4", "DAY"), ("F", "2026-01-01", "RN", "5", "10", "40", "6", "night"),
        ("F", "2026-01-02", "RN", "5", "10", "40", "0", "DAY"),
    )
    overtime = facts.fact_overtime(facts.silver_shifts(rows)).orderBy("shift_type").collect()
    assert [(r.shift_type, r.overtime_cost_est) for r in overtime] == [("DAY", 260.0), ("NIGHT", 390.0)]
    assert facts.fact_staffing(facts.silver_staffing(rows)).count() == 2


def test_snapshot_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark, spark.range(3), path)
    old = spark.read.parquet(tables.snapshot_folder(spark, path))
    tables.write_snapshot(spark, spark.range(2).withColumn("x", F.lit("new")), path)
    new = spark.read.parquet(tables.snapshot_folder(spark, path))
    assert (old.count(), new.count(), new.columns) == (3, 2, ["id", "x"])


def test_only_the_last_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        tables.write_snapshot(spark, spark.range(n), path, keep=2)
    assert len(list((tmp_path / "t").glob("version=*"))) == 2
    assert spark.read.parquet(tables.snapshot_folder(spark, path)).count() == 4


def test_staged_folder_goes_with_its_block(spark):
    with tables.staged(spark, spark.range(5)) as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 5 and tables.path_exists(spark, folder)
    assert not tables.path_exists(spark, folder)


def test_cleared_keys_leave_and_an_emptied_day_goes(spark, tmp_path, staffing_frame):
    root, table = str(tmp_path), TABLES["fact_overtime"]

    def shift(day, overtime, kind="DAY", at="2026-01-01"):
        return staffing_frame(("F", day, "RN", "5", "10", "40", overtime, kind), ingested=at)

    first = shift("2026-01-01", "4").union(shift("2026-01-01", "5", "NIGHT")).union(shift("2026-01-02", "6"))
    jobs.upsert_overtime(spark, root, facts.silver_shifts(first))
    fixes = shift("2026-01-01", "0", at="2026-02-01").union(shift("2026-01-02", "0", at="2026-02-01")).union(shift("2026-01-05", "0"))
    for _ in range(2):
        jobs.upsert_overtime(spark, root, facts.silver_shifts(fixes))
        left = tables.read_table(spark, table, root).collect()
        assert [(r.work_date, r.shift_type) for r in left] == [(date(2026, 1, 1), "NIGHT")]


def test_older_rows_do_not_replace_newer_ones(spark, tmp_path, staffing_frame):
    root = str(tmp_path)
    newer = facts.silver_staffing(staffing_frame(staff("2026-01-01", 2), ingested="2026-02-01"))
    older = facts.silver_staffing(staffing_frame(staff("2026-01-01", 1), staff("2026-01-02", 3), ingested="2026-01-01"))
    for batch in (newer, older):
        upsert.upsert_table(spark, SILVER, root, batch, newest_by=facts.NEWEST_FIRST)
    assert stored(spark, root) == {("F", date(2026, 1, 1)): 2, ("F", date(2026, 1, 2)): 3}


def test_shifts_are_formed_once_for_the_overtime_upsert(spark, tmp_path, staffing_frame, monkeypatch):
    seen = []
    formed = jobs.fact_overtime
    monkeypatch.setattr(jobs, "fact_overtime", lambda rows: seen.append(rows._jdf.queryExecution().optimizedPlan().toString()) or formed(rows))
    rows = staffing_frame(("F", "2026-01-01", "RN", "5", "10", "40", "4", "DAY"))
    jobs.upsert_overtime(spark, str(tmp_path), facts.silver_shifts(rows))
    assert len(seen) == 2 and not any("Window" in plan for plan in seen)
