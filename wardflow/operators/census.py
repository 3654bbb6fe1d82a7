"""Hourly running census from admit / discharge / transfer events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.functions.staffing import all_of
from wardflow.operators.dedup import latest_per_key
from wardflow.sources.tables import stage

UNIT = ["facility_id", "unit_id"]
HOUR = [*UNIT, "event_date", "event_hour"]


def unique_events(events: DataFrame) -> DataFrame:
    """Each event once, so that a replayed stream counts nothing twice."""
    tie_break = [c for c in ("_kinesis_timestamp", "_kinesis_sequence", "unit_id", "event_type") if c in events.columns]
    return latest_per_key(events, ["event_id"], [F.col(c).asc() for c in tie_break])


def hourly_net(events: DataFrame) -> DataFrame:
    """Net census step and event counts per unit and hour.

    Partial aggregation leaves one row per task, unit and hour, so a unit with
    a third of all events still shuffles only its hours. Events without a
    readable time have no hour and stay in Silver.
    """
    return (
        events.filter(F.col("event_ts").isNotNull())
        .groupBy(*HOUR)
        .agg(
            F.sum("census_delta").alias("net"),
            F.count_if(F.col("event_type_std") == "ADMIT").alias("admits"),
            F.count_if(F.col("event_type_std") == "DISCHARGE").alias("discharges"),
            F.count_if(F.col("event_type_std") == "TRANSFER").alias("transfers"),
        )
    )


def _running() -> Window:
    return (
        Window.partitionBy(*UNIT)
        .orderBy("event_date", "event_hour")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def hourly_census(events: DataFrame) -> DataFrame:
    """Census at the end of each hour with an event, per unit.

    The running sum goes over hourly nets, not events: the last running value
    within an hour equals the sum of all nets up to it, and a unit's window
    holds at most 24 rows per day however many events it has.
    """
    return (
        hourly_net(events)
        .withColumn("census", F.sum("net").over(_running()))
        .select(*HOUR, "census", "admits", "discharges", "transfers")
    )


def running_census(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Census after every event: the per-event form of the same sum.

    Events are cut into range slices of (unit, time, id), so a busy unit spans
    many slices and no window holds more than one slice. Each slice's opening
    value is the sum of the unit's earlier slices. The slices are staged: both
    uses must see the same cut.
    """
    timed = events.filter(F.col("event_ts").isNotNull())
    sliced = stage(
        spark,
        timed.repartitionByRange(*UNIT, "event_ts", "event_id").withColumn("_slice", F.spark_partition_id()),
        "census",
    )
    earlier = Window.partitionBy(*UNIT).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        sliced.groupBy(*UNIT, "_slice")
        .agg(F.sum("census_delta").alias("_net"))
        .withColumn("_opening", F.coalesce(F.sum("_net").over(earlier), F.lit(0)))
    )
    within = (
        Window.partitionBy(*UNIT, "_slice")
        .orderBy("event_ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same_slice = [F.col(f"e.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*UNIT, "_slice")]
    return (
        sliced.withColumn("_within", F.sum("census_delta").over(within))
        .alias("e")
        .join(opening.alias("o"), same_slice)
        .select("e.*", (F.col("o._opening") + F.col("e._within")).alias("census"))
        .drop("_within", "_slice")
    )


def _of_unit(prefix: str) -> Column:
    return all_of([F.col(c).eqNullSafe(F.col(f"{prefix}_{c}")) for c in UNIT])


def touched_units(batch: DataFrame) -> DataFrame:
    """(t_facility_id, t_unit_id, from_day): the units of a batch and their earliest day in it."""
    dated = batch.filter(F.col("event_ts").isNotNull())
    return dated.groupBy(*[F.col(c).alias(f"t_{c}") for c in UNIT]).agg(F.min("event_date").alias("from_day"))


def touched_hours(batch: DataFrame, silver: DataFrame) -> DataFrame:
    """Nets of all hours in the (unit, day) pairs a batch has events of.

    ``silver`` holds these days, the batch and all replays included, so a day's
    nets are the same however often the batch is run.
    """
    days = batch.filter(F.col("event_ts").isNotNull()).select(*[F.col(c).alias(f"t_{c}") for c in UNIT], F.col("event_date").alias("t_day")).distinct()
    same_day = _of_unit("t") & (F.col("event_date") == F.col("t_day"))
    return hourly_net(unique_events(silver.join(days, same_day, "left_semi")))


def later_hours(fact: DataFrame, units: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored hours of touched units after their earliest day, but for those in ``fresh``.

    An hour's net is its admits less its discharges, whatever census is stored.
    """
    moved = fact.join(units, _of_unit("t") & (F.col("event_date") > F.col("from_day"))).select(*fact.columns)
    known = fresh.select(*[F.col(c).alias(f"f_{c}") for c in UNIT], F.col("event_date").alias("f_day")).distinct()
    rest = moved.join(known, _of_unit("f") & (F.col("event_date") == F.col("f_day")), "left_anti")
    return rest.select(*HOUR, (F.col("admits") - F.col("discharges")).alias("net"), "admits", "discharges", "transfers", F.col("census").alias("held"))


def opening_balances(balances: DataFrame, units: DataFrame) -> DataFrame:
    """(t_facility_id, t_unit_id, opening): each unit's balance before its earliest touched day, where there is one."""
    earlier = balances.join(units, _of_unit("t") & (F.col("event_date") < F.col("from_day")))
    return earlier.groupBy("t_facility_id", "t_unit_id").agg(F.max_by("balance", "event_date").alias("opening"))


def census_from(hours: DataFrame, openings: DataFrame) -> DataFrame:
    """Census after each of ``hours``, which start where ``openings`` end."""
    census = F.sum("net").over(_running()) + F.coalesce("opening", F.lit(0))
    return hours.join(openings, _of_unit("t"), "left").withColumn("census", census).drop("t_facility_id", "t_unit_id", "opening", "net")


def closing_balances(census: DataFrame) -> DataFrame:
    """Each unit's balance at the end of each day with an event."""
    return census.groupBy(*UNIT, "event_date").agg(F.max_by("census", "event_hour").alias("balance"))
