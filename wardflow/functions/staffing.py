"""Column expressions for staffing rows: dates, keys, casts, ratios, rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.config import (
    MAX_OVERTIME_HOURS,
    MAX_PATIENT_CENSUS,
    OVERTIME_BLENDED_RATE,
    REQUIRED_FIELDS,
    UNDERSTAFFED_THRESHOLD,
)


def _iso_date(text: Column, year: int, month: int, day: int) -> Column:
    """Date from the 1-based offsets of its parts; NULL if not a real date."""
    parts = [F.substring(text, year, 4), F.substring(text, month, 2), F.substring(text, day, 2)]
    return F.concat_ws("-", *parts).try_cast("date")


def parse_work_date(col: str | Column = "work_date") -> Column:
    """Date from any accepted spelling, US before EU; NULL if none fits.

    The six formats differ in shape except the two slash forms, so the digit
    mask picks the format and a plain cast reads it. A failing pattern parser
    raises (and discards) one exception per row and format, which costs more
    than all the rest of the Silver projection.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    mask = F.translate(text, "123456789", "000000000")
    time_ok = F.concat(F.lit("2000-01-01 "), F.substring(text, 12, 8)).try_cast("timestamp").isNotNull()
    return (
        F.when(mask == "00/00/0000", F.coalesce(_iso_date(text, 7, 1, 4), _iso_date(text, 7, 4, 1)))
        .when(mask == "0000-00-00", _iso_date(text, 1, 6, 9))
        .when(mask == "00000000", _iso_date(text, 1, 5, 7))
        .when(mask == "00-00-0000", _iso_date(text, 7, 1, 4))
        .when((mask == "0000-00-00 00:00:00") & time_ok, _iso_date(text, 1, 6, 9))
    )


def hash_key(*cols: str | Column) -> Column:
    """SHA-256 of the parts joined by '|'; a NULL part counts as empty."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def as_int(col: str | Column) -> Column:
    """INT from text. ``12.0`` reads as 12; text that is no number is NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def safe_ratio(numerator: str, denominator: str, scale: int = 3) -> Column:
    """Quotient to ``scale`` places; NULL when the denominator is 0."""
    return F.round(F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double")), scale)


def cast_silver_types(df: DataFrame) -> DataFrame:
    """Typed Silver row from an all-string Bronze row; other columns pass through."""
    return (
        df.withColumn("work_date", parse_work_date("work_date"))
        .withColumns(
            {
                "staffing_id": hash_key("facility_id", "work_date", "role_code"),
                "staff_count": as_int("staff_count"),
                "patient_census": as_int("patient_census"),
                "hours_worked": F.col("hours_worked").try_cast("double"),
                "hours_worked_overtime": F.col("hours_worked_overtime").try_cast("double"),
                "shift_type": F.upper(F.trim("shift_type")),
            }
        )
        .withColumnRenamed("hours_worked_overtime", "hours_overtime")
        .withColumns(
            {
                "nurse_patient_ratio": safe_ratio("staff_count", "patient_census"),
                "overtime_pct": safe_ratio("hours_overtime", "hours_worked"),
            }
        )
    )


def _is_blank(col: str) -> Column:
    text = F.col(col).cast("string")
    return text.isNull() | (text == "")


def _fired(rules: list[tuple[Column, str]]) -> Column:
    """Names of the rules that hold, as compiled array pieces put together."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(broken, F.array(F.lit(name))).otherwise(none) for broken, name in rules])


def build_dq_flags_column(
    required_fields: list[str] = REQUIRED_FIELDS,
    max_census: int = MAX_PATIENT_CENSUS,
    max_ot: float = MAX_OVERTIME_HOURS,
    ot_column: str = "hours_overtime",
) -> Column:
    """Array of the rules a typed row breaks; empty means clean."""
    rules = [(_is_blank(f), f"NULL_{f.upper()}") for f in required_fields]
    rules += [
        (F.col("patient_census") > max_census, "CENSUS_OUT_OF_RANGE"),
        (F.col("patient_census") < 0, "NEGATIVE_CENSUS"),
        (F.col(ot_column) > max_ot, "OT_HOURS_EXCEED_MAX"),
        (F.col("staff_count") < 0, "NEGATIVE_STAFF_COUNT"),
    ]
    return _fired(rules)


def _validator_rules(columns: list[str], max_census: int, max_ot: float) -> list[tuple[Column, str]]:
    census = F.col("patient_census").try_cast("double")
    overtime = F.col("hours_worked_overtime").try_cast("double")
    staff = F.col("staff_count").try_cast("double")
    rules = [
        ("facility_id", _is_blank("facility_id"), "NULL_FACILITY_ID"),
        ("patient_census", (census < 0) | (census > max_census), "CENSUS_OUT_OF_RANGE"),
        ("hours_worked_overtime", overtime > max_ot, "OT_HOURS_EXCEED_MAX"),
        ("staff_count", staff < 0, "NEGATIVE_STAFF_COUNT"),
        ("staff_count", as_int("staff_count").isNull(), "STAFF_COUNT_NOT_NUMERIC"),
    ]
    return [(broken, name) for field, broken, name in rules if field in columns]


def validation_reasons(
    columns: list[str], max_census: int = MAX_PATIENT_CENSUS, max_ot: float = MAX_OVERTIME_HOURS
) -> Column:
    """Array of the validator rules an all-string row breaks.

    A rule applies when its field is among ``columns``, so events and staffing
    rows share one rule set. Limits compare as numbers of any form: ``1600.5``
    is out of range even though it is no whole count. A staffing row without
    a staff count is not numeric.
    """
    return _fired(_validator_rules(columns, max_census, max_ot))


def breaks_a_rule(
    columns: list[str], max_census: int = MAX_PATIENT_CENSUS, max_ot: float = MAX_OVERTIME_HOURS
) -> Column:
    """Whether :func:`validation_reasons` is non-empty, without the array."""
    tests = [F.coalesce(broken, F.lit(False)) for broken, _ in _validator_rules(columns, max_census, max_ot)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def date_key(col: str | Column) -> Column:
    """Date as the integer yyyymmdd."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def date_of_key(col: str) -> Column:
    """Inverse of :func:`date_key`."""
    k = F.col(col)
    return F.make_date(F.floor(k / 10000).cast("int"), (F.floor(k / 100) % 100).cast("int"), (k % 100).cast("int"))


def is_understaffed(threshold: float = UNDERSTAFFED_THRESHOLD) -> Column:
    return F.col("nurse_patient_ratio") < threshold


def overtime_cost(rate: float = OVERTIME_BLENDED_RATE) -> Column:
    return F.col("hours_overtime") * rate


def is_weekend(date_col: str | Column) -> Column:
    """True on Sunday (1) and Saturday (7)."""
    return F.dayofweek(date_col).isin(1, 7)


def short_error(col: str | Column, limit: int = 500) -> Column:
    """Error text cut to the length the run log stores."""
    return F.substring(col, 1, limit)


def milli_sum(col: str) -> Column:
    """Exact sum of a 3-place ratio, in thousandths.

    Whole-number sums do not depend on the order in which partitions arrive,
    so averages built on them repeat bit for bit across retries.
    """
    return F.sum(F.round(F.col(col) * 1000).cast("bigint"))


def ratio_avg(col: str) -> Column:
    """Average of a 3-place ratio, from the exact sum."""
    return F.try_divide(milli_sum(col), F.count(col) * 1000)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
