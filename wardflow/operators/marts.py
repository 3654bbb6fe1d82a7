"""KPI marts over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.config import VALIDATION_RULES
from wardflow.functions.staffing import ratio_avg
from wardflow.operators.quality import pass_rate


def facility_daily_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("facility_id", "work_date").agg(
        F.sum("staff_count").alias("staff_total"),
        F.sum("patient_census").alias("census_total"),
        F.sum("hours_overtime").alias("overtime_hours"),
        ratio_avg("nurse_patient_ratio").alias("avg_nurse_patient_ratio"),
        F.count_if("is_understaffed").alias("understaffed_roles"),
    )


def np_ratio_realtime(census: DataFrame, fact: DataFrame) -> DataFrame:
    """Current census of each facility against its latest day of staffing.

    Current census is the sum over units of each unit's last hourly value.
    """
    units = census.groupBy("facility_id", "unit_id").agg(
        F.max_by("census", F.struct("event_date", "event_hour")).alias("census"), F.max("event_date").alias("as_of_date")
    )
    return _np_ratio(units, fact.groupBy("facility_id", "work_date").agg(F.sum("staff_count").alias("staff")))


def np_ratio_of_balances(balances: DataFrame, daily: DataFrame) -> DataFrame:
    """The same from the units' closing balances and :func:`facility_daily_summary`."""
    units = balances.groupBy("facility_id", "unit_id").agg(
        F.max_by("balance", "event_date").alias("census"), F.max("event_date").alias("as_of_date")
    )
    return _np_ratio(units, daily.select("facility_id", "work_date", F.col("staff_total").alias("staff")))


def _np_ratio(units: DataFrame, daily: DataFrame) -> DataFrame:
    now = units.groupBy("facility_id").agg(
        F.sum("census").alias("census_now"), F.max("as_of_date").alias("as_of_date")
    )
    return (
        now.join(daily, "facility_id", "left")
        .groupBy("facility_id", "census_now", "as_of_date")
        .agg(
            F.max_by("staff", F.when(F.col("work_date") <= F.col("as_of_date"), F.col("work_date"))).alias("staff_now"),
            F.max(F.when(F.col("work_date") <= F.col("as_of_date"), F.col("work_date"))).alias("staff_date"),
        )
        .withColumn(
            "np_ratio", F.round(F.try_divide(F.col("staff_now").cast("double"), F.col("census_now").cast("double")), 3)
        )
    )


def ot_summary_monthly(overtime: DataFrame) -> DataFrame:
    return overtime.groupBy(
        "facility_id", "role_code", F.trunc("work_date", "month").alias("month")
    ).agg(
        F.sum("hours_overtime").alias("overtime_hours"),
        F.sum("overtime_cost_est").alias("overtime_cost"),
        F.count(F.lit(1)).alias("overtime_rows"),
    )


def scorecard_quarterly(fact: DataFrame, overtime: DataFrame) -> DataFrame:
    """Both facts are reduced to (facility, quarter) before they meet."""
    quarter = F.trunc("work_date", "quarter").alias("quarter")
    staffing = fact.groupBy("facility_id", quarter).agg(
        ratio_avg("nurse_patient_ratio").alias("avg_nurse_patient_ratio"),
        F.try_divide(F.count_if("is_understaffed"), F.count("is_understaffed")).alias("understaffed_share"),
    )
    extra = overtime.groupBy("facility_id", quarter).agg(
        F.round(F.try_divide(F.sum("hours_overtime"), F.sum("hours_worked")), 3).alias("overtime_pct"),
        F.sum("overtime_cost_est").alias("overtime_cost"),
    )
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("facility_id", "quarter")]
    return (
        staffing.alias("s")
        .join(extra.alias("o"), same, "left")
        .select("s.*", "o.overtime_pct", F.coalesce("o.overtime_cost", F.lit(0.0)).alias("overtime_cost"))
    )


def dq_dashboard(results: DataFrame) -> DataFrame:
    """Pass rate and rule counts per dataset and day, from the DQ results."""
    rule = {r: F.coalesce(F.try_element_at("error_summary", F.lit(r)), F.lit(0)) for r in VALIDATION_RULES}
    return (
        results.groupBy("dataset_name", F.to_date("run_timestamp").alias("run_date"))
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("valid_records").alias("valid_records"),
            *[F.sum(count).alias(name.lower()) for name, count in rule.items()],
        )
        .withColumn("pass_rate", pass_rate())
    )


def current_facilities(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")
