"""Silver staffing grains and the staffing and overtime facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.staffing import (
    build_dq_flags_column,
    cast_silver_types,
    date_key,
    hash_key,
    is_understaffed,
    overtime_cost,
)
from wardflow.operators.dedup import latest_per_key

NEWEST_FIRST = ["_ingested_at", "_record_index"]


def typed_staffing(bronze: DataFrame) -> DataFrame:
    """Typed, flagged staffing rows before deduplication."""
    return cast_silver_types(bronze).withColumn("_dq_flags", build_dq_flags_column())


def silver_staffing(bronze: DataFrame) -> DataFrame:
    """Latest row per staffing_id (facility, date, role)."""
    return latest_per_key(typed_staffing(bronze), ["staffing_id"], NEWEST_FIRST)


def shift_id() -> Column:
    """Key of a shift: facility, date, role and shift type."""
    return hash_key("facility_id", "work_date", "role_code", "shift_type")


def silver_shifts(bronze: DataFrame) -> DataFrame:
    """Latest row per shift_id (facility, date, role, shift).

    The staffing_id grain holds one shift a day; overtime needs each of them.
    """
    keyed = typed_staffing(bronze).withColumn("shift_id", shift_id())
    return latest_per_key(keyed, ["shift_id"], NEWEST_FIRST)


def latest_staffing(silver: DataFrame, key: str = "staffing_id") -> DataFrame:
    """Dedup before every Gold merge.

    The id is a hash of exactly the Gold grain, so on a frame fresh from
    Silver this window reuses the Silver exchange and sort.
    """
    return latest_per_key(silver.filter(F.col("work_date").isNotNull()), [key], NEWEST_FIRST)


def fact_staffing(silver: DataFrame, understaffed: Column | None = None) -> DataFrame:
    """One row per (date_key, facility, role); undated rows stay in Silver."""
    return latest_staffing(silver).select(
        date_key("work_date").alias("date_key"),
        "facility_id",
        "role_code",
        "work_date",
        "staff_count",
        "patient_census",
        "hours_worked",
        "hours_overtime",
        "nurse_patient_ratio",
        "overtime_pct",
        (is_understaffed() if understaffed is None else understaffed).alias("is_understaffed"),
        F.size("_dq_flags").alias("dq_flag_count"),
    )


def fact_overtime(shifts: DataFrame) -> DataFrame:
    """Overtime per (date_key, facility, role, shift) with its estimated cost."""
    return (
        latest_staffing(shifts, "shift_id")
        .filter("hours_overtime > 0")
        .select(
            date_key("work_date").alias("date_key"),
            "facility_id",
            "role_code",
            "shift_type",
            "work_date",
            "hours_worked",
            "hours_overtime",
            "overtime_pct",
            overtime_cost().alias("overtime_cost_est"),
        )
    )
