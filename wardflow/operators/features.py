"""Seven-day rolling overtime features and the next-day label."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.staffing import all_of, date_of_key, is_weekend

SERIES = ["facility_id", "role_code"]

FEATURE_COLUMNS = [
    "date_key", "facility_id", "role_code", "staff_count", "patient_census", "hours_overtime",
    "nurse_patient_ratio", "overtime_pct", "is_understaffed", "avg_census_7d", "avg_staff_7d",
    "avg_ot_pct_7d", "total_ot_hours_7d", "census_vs_avg", "is_weekend", "overtime_pct_lag1",
    "will_overtime_next_day", "will_overtime_next_calendar_day",
]


def overtime_features(fact: DataFrame) -> DataFrame:
    """Features of one row per (date_key, facility, role) of ``fact_staffing``.

    All windows share one partitioning and order: one shuffle, one sort. The
    fact holds one row per date in each series, so a series is bounded by the
    calendar whatever the size of a facility.
    """
    day = F.unix_date("_day")
    in_order = Window.partitionBy(*SERIES).orderBy(day)
    week = in_order.rangeBetween(-6, 0)
    milli_pct = F.round(F.col("overtime_pct") * 1000).cast("bigint")
    next_pct = F.lead("overtime_pct", 1).over(in_order)
    next_day = F.lead("_day", 1).over(in_order)
    return (
        fact.withColumn("_day", date_of_key("date_key"))
        .withColumns(
            {
                "avg_census_7d": F.avg("patient_census").over(week),
                "avg_staff_7d": F.avg("staff_count").over(week),
                "avg_ot_pct_7d": F.try_divide(
                    F.sum(milli_pct).over(week), F.count("overtime_pct").over(week) * 1000
                ),
                "total_ot_hours_7d": F.sum("hours_overtime").over(week),
                "overtime_pct_lag1": F.lag("overtime_pct", 1).over(in_order),
                "will_overtime_next_day": next_pct > 0,
                "will_overtime_next_calendar_day": F.when(next_day == F.date_add("_day", 1), next_pct > 0),
            }
        )
        .withColumns(
            {
                "census_vs_avg": F.col("patient_census") - F.col("avg_census_7d"),
                "is_weekend": is_weekend("_day"),
                "is_understaffed": F.col("is_understaffed").cast("int"),
            }
        )
        .select(*FEATURE_COLUMNS)
    )


def _of_series(prefix: str) -> Column:
    return all_of([F.col(c).eqNullSafe(F.col(f"{prefix}_{c}")) for c in SERIES])


def affected_ranges(fact: DataFrame, changed: DataFrame, start: date, from_begin: bool, to_end: bool) -> DataFrame:
    """(r_facility_id, r_role_code, first, last, complete): the days of each
    changed series whose features a change of some of its days can move.

    ``changed`` holds (date_key, facility_id, role_code). A change moves the
    next seven days, the next stored day through its lag and the stored day
    before through its label. ``fact`` may be a part of all days, beginning at
    ``start``; ``from_begin`` and ``to_end`` tell whether anything is stored
    before and after it. A range is complete if what its features look at lies
    within that part too.
    """
    moved = changed.groupBy(*[F.col(c).alias(f"r_{c}") for c in SERIES]).agg(
        F.min(date_of_key("date_key")).alias("lo"), F.max(date_of_key("date_key")).alias("hi")
    )
    stored = fact.join(moved, _of_series("r")).groupBy("r_facility_id", "r_role_code", "lo", "hi").agg(
        F.array_sort(F.collect_set(date_of_key("date_key"))).alias("days")
    )
    earlier = F.array_max(F.filter("days", lambda d: d < F.col("lo")))
    later = F.array_min(F.filter("days", lambda d: d > F.col("hi")))
    ranges = stored.withColumn("first", F.coalesce(earlier, "lo")).withColumn("last", F.greatest(F.date_add("hi", 6), later))
    seen_before = F.exists("days", lambda d: d < F.col("first")) & (F.date_sub("first", 6) >= F.lit(start))
    seen_after = F.exists("days", lambda d: d > F.col("last"))
    complete = (seen_before | F.lit(from_begin)) & (seen_after | F.lit(to_end))
    return ranges.select("r_facility_id", "r_role_code", "first", "last", complete.alias("complete"))


def features_in(fact: DataFrame, ranges: DataFrame) -> DataFrame:
    """Features of the days in ``ranges``, from the rows of their series in ``fact``."""
    series = fact.join(ranges.select("r_facility_id", "r_role_code"), _of_series("r"), "left_semi")
    day = date_of_key("date_key")
    inside = _of_series("r") & day.between(F.col("first"), F.col("last"))
    return overtime_features(series).join(ranges, inside, "left_semi")
