import random
from datetime import date, timedelta
from pathlib import Path

import pytest

from wardflow.operators import features, marts, upsert
from wardflow.plans import jobs
from wardflow.schemas import TABLES
from wardflow.sources import tables

DDL = ("date_key INT, facility_id STRING, role_code STRING, work_date DATE, staff_count INT, patient_census INT,"
       " hours_worked DOUBLE, hours_overtime DOUBLE, nurse_patient_ratio DOUBLE, overtime_pct DOUBLE,"
       " is_understaffed BOOLEAN, dq_flag_count INT")


@pytest.fixture
def fact(spark):
    rng = random.Random(3)
    rows = []
    for facility in ("A", "B"):
        for offset in sorted(rng.sample(range(40), 22)):
            day = date(2026, 1, 1) + timedelta(days=offset)
            pct = rng.choice([None, 0.0, round(rng.random(), 3)])
            rows.append((int(day.strftime("%Y%m%d")), facility, "RN", day, rng.randrange(1, 9), rng.randrange(10, 90),
                         40.0, float(rng.randrange(0, 20)), 0.2, pct, rng.choice([True, False, None]), 0))
    return spark.createDataFrame(rows, DDL)


def test_features_against_a_plain_computation(fact):
    rows = fact.collect()
    got = {(r.facility_id, r.date_key): r for r in features.overtime_features(fact).collect()}
    assert len(got) == len(rows)
    for facility in ("A", "B"):
        series = sorted((r for r in rows if r.facility_id == facility), key=lambda r: r.work_date)
        for i, r in enumerate(series):
            week = [x for x in series if timedelta(0) <= r.work_date - x.work_date <= timedelta(days=6)]
            f = got[(facility, r.date_key)]
            assert f.avg_census_7d == pytest.approx(sum(x.patient_census for x in week) / len(week))
            assert f.avg_staff_7d == pytest.approx(sum(x.staff_count for x in week) / len(week))
            assert f.total_ot_hours_7d == sum(x.hours_overtime for x in week)
            pcts = [x.overtime_pct for x in week if x.overtime_pct is not None]
            assert f.avg_ot_pct_7d == (pytest.approx(sum(pcts) / len(pcts)) if pcts else None)
            assert f.census_vs_avg == pytest.approx(r.patient_census - f.avg_census_7d)
            assert f.is_weekend == (r.work_date.weekday() >= 5)
            assert f.is_understaffed == (None if r.is_understaffed is None else int(r.is_understaffed))
            nxt = series[i + 1] if i + 1 < len(series) else None
            label = None if nxt is None or nxt.overtime_pct is None else nxt.overtime_pct > 0
            assert f.will_overtime_next_day == label
            strict = nxt is not None and nxt.work_date - r.work_date == timedelta(days=1)
            assert f.will_overtime_next_calendar_day == (label if strict else None)
            assert f.overtime_pct_lag1 == (series[i - 1].overtime_pct if i else None)


def test_all_windows_share_one_shuffle(fact):
    plan = features.overtime_features(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_realtime_ratio_uses_the_latest_staffing_day(spark, fact):
    hours = spark.createDataFrame(
        [("A", "U1", date(2026, 1, 20), 5, 10, 0, 0, 0), ("A", "U1", date(2026, 1, 20), 4, 99, 0, 0, 0),
         ("A", "U2", date(2026, 1, 19), 9, 6, 0, 0, 0), ("Z", "U1", date(2026, 1, 1), 1, 0, 0, 0, 0)],
        "facility_id STRING, unit_id STRING, event_date DATE, event_hour INT, census BIGINT, admits BIGINT,"
        " discharges BIGINT, transfers BIGINT")
    got = {r.facility_id: r for r in marts.np_ratio_realtime(hours, fact).collect()}
    latest = max((r for r in fact.collect() if r.facility_id == "A" and r.work_date <= date(2026, 1, 20)),
                 key=lambda r: r.work_date)
    assert (got["A"].census_now, got["A"].staff_now, got["A"].staff_date) == (16, latest.staff_count, latest.work_date)
    assert got["A"].np_ratio == round(latest.staff_count / 16, 3)
    assert (got["Z"].census_now, got["Z"].staff_now, got["Z"].np_ratio) == (0, None, None)


def stored_fact(spark, root, rows):
    upsert.upsert_table(spark, TABLES["fact_staffing"], root, spark.createDataFrame(rows, DDL))


def fact_row(facility, day, rng):
    return (int(day.strftime("%Y%m%d")), facility, "RN", day, rng.randrange(1, 9), rng.randrange(10, 90), 40.0,
            float(rng.randrange(0, 20)), 0.2, rng.choice([None, 0.0, 0.3]), rng.choice([True, False, None]), 0)


def feature_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    """Corrections, late days before all others, new days, and neighbours months away."""
    root, rng, table = str(tmp_path), random.Random(5), TABLES["overtime_features"]
    begin = date(2024, 1, 1)
    offsets = {"A": range(0, 700, 3), "B": [0, 1, 5, 250, 251, 640], None: range(300, 340), "C": [10, 699]}
    stored_fact(spark, root, [fact_row(f, begin + timedelta(days=d), rng) for f, days in offsets.items() for d in days])
    fact = lambda: tables.read_table(spark, TABLES["fact_staffing"], root)
    tables.write_snapshot(spark, features.overtime_features(fact()), table.path(root), table)
    batches = [[("A", 300), ("B", 251), (None, 339)], [("B", 249)], [("B", 645), ("C", 698), ("D", 350)], [("A", -40), ("C", 11)], [("A", 698), ("B", 1)]]
    for batch in batches:
        rows = [fact_row(f, begin + timedelta(days=d), rng) for f, d in batch]
        stored_fact(spark, root, rows)
        changed = spark.createDataFrame(rows, DDL).select("date_key", "facility_id", "role_code")
        written = jobs.refresh_features(spark, root, changed)
        assert feature_rows(tables.read_snapshot(spark, table, root)) == feature_rows(features.overtime_features(fact()))
        assert len(batch) <= written <= 12 * len(batch)


def test_refresh_leaves_other_months_alone(spark, tmp_path):
    root, rng, table = str(tmp_path), random.Random(6), TABLES["overtime_features"]
    stored_fact(spark, root, [fact_row("A", date(2024, 1, 1) + timedelta(days=d), rng) for d in range(400)])
    folder = tables.write_snapshot(spark, features.overtime_features(tables.read_table(spark, TABLES["fact_staffing"], root)), table.path(root), table)
    files = lambda: {p.parent.name: p.name for p in Path(folder).rglob("*.parquet")}
    before = files()
    rows = [fact_row("A", date(2024, 6, 10), rng)]
    stored_fact(spark, root, rows)
    assert jobs.refresh_features(spark, root, spark.createDataFrame(rows, DDL).select("date_key", "facility_id", "role_code")) == 8
    assert {m for m, name in files().items() if before[m] != name} == {"month_key=202406"}
