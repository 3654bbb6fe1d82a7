import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.functions import adt
from wardflow.operators import census
from wardflow.schemas import TABLES
from wardflow.sources import tables
from wardflow.streaming import adt as streams

SILVER = TABLES["adt_events_standardized"]
FACT = TABLES["fact_census_realtime"]


def rows(n, seed=1):
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    out = []
    for i in range(n):
        at = start + timedelta(minutes=rng.randrange(0, 3 * 24 * 60))
        facility = "FAC_0" if rng.random() < 0.4 else rng.choice(["FAC_1", None])
        out.append((rng.choice("ADTX"), facility, rng.choice(["U1", "U2"]), f"P{i}", at.strftime("%Y-%m-%dT%H:%M:%SZ"), i))
    return out


@pytest.fixture
def events(spark):
    df = spark.createDataFrame(
        rows(600), "event_type STRING, facility_id STRING, unit_id STRING, patient_id STRING, event_timestamp STRING, n INT"
    )
    return adt.standardize_events(df)


def expected(collected):
    """Census per unit and hour by walking the events in order."""
    running, out = {}, {}
    for r in sorted(collected, key=lambda r: (r.event_ts, r.event_id)):
        unit = (r.facility_id, r.unit_id)
        running[unit] = running.get(unit, 0) + r.census_delta
        cell = out.setdefault((*unit, r.event_date, r.event_hour), [0, 0, 0, 0])
        cell[0] = running[unit]
        for i, kind in enumerate(("ADMIT", "DISCHARGE", "TRANSFER"), 1):
            cell[i] += r.event_type_std == kind
    return {k: tuple(v) for k, v in out.items()}


def as_dict(df):
    return {
        (r.facility_id, r.unit_id, r.event_date, r.event_hour): (r.census, r.admits, r.discharges, r.transfers)
        for r in df.collect()
    }


def test_hourly_census_equals_a_walk_over_events(events):
    assert as_dict(census.hourly_census(events)) == expected(events.collect())


def test_running_census_spans_slices(spark, events):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        running = census.running_census(spark, events)
        last = running.groupBy(*census.HOUR).agg(F.max_by("census", F.struct("event_ts", "event_id")).alias("c"))
        got = {(r.facility_id, r.unit_id, r.event_date, r.event_hour): r.c for r in last.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert running.count() == 600
    assert got == {k: v[0] for k, v in expected(events.collect()).items()}


def test_replay_counts_nothing_twice(events):
    twice = events.unionByName(events.filter("n % 3 = 0"))
    assert as_dict(census.hourly_census(census.unique_events(twice))) == expected(events.collect())


def as_silver(events):
    missing = {f.name: F.lit(None).cast(f.dataType) for f in SILVER.struct if f.name not in events.columns}
    return events.withColumns(missing)


def put(spark, root, rows):
    """Rows into Silver, and the census after them."""
    batch = tables.stage(spark, rows.select(*SILVER.struct.names))
    batch.write.mode("append").partitionBy("event_date").parquet(SILVER.path(root))
    streams.update_census(spark, batch, root)
    return batch


def files_of(folder):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in folder.glob("event_date=*")}


def one_event(spark, kind, unit, at, patient="P"):
    return as_silver(adt.standardize_events(spark.createDataFrame(
        [(kind, "F1", unit, patient, at)], "event_type STRING, facility_id STRING, unit_id STRING, patient_id STRING, event_timestamp STRING")))


def test_one_event_five_years_late(spark, tmp_path):
    """Every later hour of its unit moves, nothing else is read or rewritten."""
    root, fact = str(tmp_path), tmp_path / "gold/fact_census_realtime"
    days = ["2021-02-03", "2021-02-04", "2024-07-01", "2026-01-01"]
    for unit, day in [("U1", d) for d in days] + [("U2", days[1]), (None, days[3])]:
        put(spark, root, one_event(spark, "ADMIT", unit, f"{day} 05:00:00"))
    before = files_of(fact)
    late = one_event(spark, "ADMIT", "U1", "2021-02-01 10:00:00", "late")
    for batch in (late, late):  # the second is a replay
        put(spark, root, batch)
        rows = tables.read_table(spark, FACT, root).collect()
        got = sorted((str(r.event_date), r.unit_id or "", r.census) for r in rows)
        assert got == [("2021-02-01", "U1", 1), ("2021-02-03", "U1", 2), ("2021-02-04", "U1", 3), ("2021-02-04", "U2", 1),
                       ("2024-07-01", "U1", 4), ("2026-01-01", "", 1), ("2026-01-01", "U1", 5)]
    after = files_of(fact)
    # A transfer, however late, moves no census: no other day is rewritten.
    put(spark, root, one_event(spark, "TRANSFER", "U1", "2020-12-01 10:00:00"))
    assert {d: f for d, f in files_of(fact).items() if d in after} == after
    assert before.keys() | {"event_date=2021-02-01"} == after.keys()
    balances = tables.read_table(spark, TABLES["census_balance"], root).filter("unit_id = 'U1'").collect()
    assert sorted((str(r.event_date), r.balance) for r in balances) == [
        ("2020-12-01", 0), ("2021-02-01", 1), ("2021-02-03", 2), ("2021-02-04", 3), ("2024-07-01", 4), ("2026-01-01", 5)]


def test_newest_day_reads_no_other_day(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
        put(spark, root, one_event(spark, "ADMIT", "U1", f"{day} 05:00:00"))
    assert streams.held_after(spark, root, date(2026, 1, 3)).isEmpty()
    held = streams.held_after(spark, root, date(2026, 1, 1))
    assert sorted(str(r.event_date) for r in held.collect()) == ["2026-01-02", "2026-01-03"]
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    units = spark.createDataFrame([("F1", "U1", date(2026, 1, 3)), ("F1", "new", date(2026, 1, 3))], "t_facility_id STRING, t_unit_id STRING, from_day DATE")
    opening = streams.openings_of(spark, root, units)
    assert [tuple(r) for r in opening.collect()] == [("F1", "U1", 2)]
    assert opening._jdf.queryExecution().executedPlan().toString().count("month_key") >= 2


def test_broken_off_update_is_completed_by_the_next_run(spark, tmp_path, monkeypatch):
    """A run that wrote the fact but not the balances is repeated without counting twice."""
    root = str(tmp_path)
    put(spark, root, one_event(spark, "ADMIT", "U1", "2026-01-02 05:00:00"))
    real = streams.upsert_table

    def first_only(spark_, table, *rest):
        if table.name == "census_balance":
            raise RuntimeError("lost")
        real(spark_, table, *rest)

    monkeypatch.setattr(streams, "upsert_table", first_only)
    with pytest.raises(RuntimeError):
        put(spark, root, one_event(spark, "ADMIT", "U1", "2026-01-01 05:00:00", "Q"))
    monkeypatch.undo()
    batch = tables.read_table(spark, SILVER, root).filter("event_date = '2026-01-01'")
    streams.update_census(spark, batch, root)
    assert sorted((str(r.event_date), r.census) for r in tables.read_table(spark, FACT, root).collect()) == [("2026-01-01", 1), ("2026-01-02", 2)]


def test_incremental_census_with_late_events(spark, tmp_path, events):
    root = str(tmp_path)
    full = as_silver(events)
    for part in ("n % 3 = 1", "n % 3 = 0", "n % 3 = 2 or n % 5 = 0"):
        batch = tables.stage(spark, full.filter(part).select(*SILVER.struct.names))
        batch.write.mode("append").partitionBy("event_date").parquet(SILVER.path(root))
        streams.update_census(spark, batch, root)
        streams.update_census(spark, batch, root)
    assert as_dict(tables.read_table(spark, FACT, root)) == expected(events.collect())
