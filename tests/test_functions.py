from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardflow.config import WORK_DATE_FORMATS
from wardflow.functions import adt, staffing


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, x STRING")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


DATES = {
    "01/21/2026": date(2026, 1, 21),
    "2026-01-21": date(2026, 1, 21),
    "21/01/2026": date(2026, 1, 21),
    "20260121": date(2026, 1, 21),
    "01-21-2026": date(2026, 1, 21),
    "2026-01-21 23:59:59": date(2026, 1, 21),
    "01/02/2026": date(2026, 1, 2),  # ambiguous: US first
    "1/2/2026": None,
    "02/30/2026": None,
    "2024-02-29": date(2024, 2, 29),
    "2023-02-29": None,
    "2026-01-21 25:00:00": None,
    "2026-13-01": None,
    "not-a-date": None,
    "": None,
    None: None,
}


def test_work_date_spellings(spark):
    assert values(spark, list(DATES), staffing.parse_work_date("x")) == list(DATES.values())


def test_work_date_equals_the_six_patterns(spark):
    by_pattern = F.coalesce(*[F.try_to_date("x", f) for f in WORK_DATE_FORMATS])
    texts = [t for t in DATES if t] + ["0000-01-01", "0000-00-00", "00000000"] + [
        f"{a:02d}{s}{b:02d}{s}2024" for s in "/-" for a in range(0, 33, 3) for b in range(0, 33, 4)
    ] + [f"2024-{a:02d}-{b:02d} {h:02d}:30:61" for a in (2, 13) for b in (29, 31) for h in (0, 24)]
    ours, patterns = staffing.parse_work_date("x").cast("string"), by_pattern.cast("string")
    assert values(spark, texts, ours) == values(spark, texts, patterns)


def test_work_date_accepts_typed_columns(spark):
    df = spark.sql("select date'2026-01-21' d, timestamp'2026-01-21 08:00:00' t")
    row = df.select(staffing.parse_work_date("d"), staffing.parse_work_date("t")).first()
    assert list(row) == [date(2026, 1, 21)] * 2


def test_int_reads_whole_and_decimal_text(spark):
    assert values(spark, ["7", "7.0", " 7 ", "abc", "", None, "-3"], staffing.as_int("x")) == [
        7, 7, 7, None, None, None, -3,
    ]


def test_key_does_not_depend_on_the_date_spelling(spark, staffing_frame):
    spellings = [d for d in DATES if DATES[d] == date(2026, 1, 21)]
    df = staffing.cast_silver_types(
        staffing_frame(*[("F", d, "RN", "5", "10", "40", "4", " day ") for d in spellings])
    )
    assert df.select("staffing_id").distinct().count() == 1
    row = df.first()
    assert (row.shift_type, row.nurse_patient_ratio, row.overtime_pct) == ("DAY", 0.5, 0.1)


def test_ratios_are_null_on_zero(staffing_frame):
    row = staffing.cast_silver_types(staffing_frame(("F", "2026-01-21", "RN", "5", "0", "0", "4", "D"))).first()
    assert row.nurse_patient_ratio is None and row.overtime_pct is None


@pytest.mark.parametrize(
    ("field", "value", "rules"),
    [
        ("facility_id", None, ["NULL_FACILITY_ID"]),
        ("facility_id", "", ["NULL_FACILITY_ID"]),
        ("patient_census", "-1", ["CENSUS_OUT_OF_RANGE"]),
        ("patient_census", "0", []),
        ("patient_census", "1500", []),
        ("patient_census", "1501", ["CENSUS_OUT_OF_RANGE"]),
        ("patient_census", "1500.5", ["CENSUS_OUT_OF_RANGE"]),
        ("hours_worked_overtime", "24", []),
        ("hours_worked_overtime", "24.01", ["OT_HOURS_EXCEED_MAX"]),
        ("staff_count", "-1", ["NEGATIVE_STAFF_COUNT"]),
        ("staff_count", "abc", ["STAFF_COUNT_NOT_NUMERIC"]),
        ("staff_count", None, ["STAFF_COUNT_NOT_NUMERIC"]),
        ("staff_count", "0", []),
    ],
)
def test_validator_boundaries(staffing_frame, field, value, rules):
    cells = {"facility_id": "F", "work_date": "2026-01-21", "role_code": "RN", "staff_count": "5",
             "patient_census": "10", "hours_worked": "40", "hours_worked_overtime": "4", "shift_type": "DAY"}
    df = staffing_frame(tuple({**cells, field: value}.values()))
    row = df.select(staffing.validation_reasons(df.columns).alias("r"), staffing.breaks_a_rule(df.columns).alias("b")).first()
    assert row.r == rules and row.b == bool(rules)


def test_validator_skips_rules_of_absent_fields(spark):
    df = spark.createDataFrame([("F",), (None,)], "facility_id STRING")
    found = [r[0] for r in df.select(staffing.validation_reasons(df.columns)).collect()]
    assert found == [[], ["NULL_FACILITY_ID"]]


def test_silver_flags(staffing_frame):
    df = staffing.cast_silver_types(
        staffing_frame((None, "junk", "", "-2", "-1", "40", "25", "D"), ("F", "2026-01-01", "RN", "2", "1501", "40", "24", "D"))
    )
    flags = [sorted(r[0]) for r in df.select(staffing.build_dq_flags_column()).collect()]
    assert flags == [
        ["NEGATIVE_CENSUS", "NEGATIVE_STAFF_COUNT", "NULL_FACILITY_ID", "NULL_ROLE_CODE", "NULL_WORK_DATE",
         "OT_HOURS_EXCEED_MAX"],
        ["CENSUS_OUT_OF_RANGE"],
    ]


def test_date_key_round_trip(spark):
    df = spark.sql("select date'2026-01-03' d").withColumn("k", staffing.date_key("d"))
    row = df.select("k", staffing.date_of_key("k").alias("d"), staffing.is_weekend("d").alias("w")).first()
    assert (row.k, row.d, row.w) == (20260103, date(2026, 1, 3), True)


def test_event_times(spark):
    texts = ["2026-01-21T08:00:00Z", "2026-01-21T08:00:00", "2026-01-21 08:00:00", "2026-01-21 08:00:00.250000",
             "01/21/2026 08:00:00", "2026-01-21T10:00:00+02:00", "21/01/2026 08:00:00", "8 o'clock", "2026-01-21", None]
    eight = datetime(2026, 1, 21, 8)
    shown = F.date_format(adt.parse_event_ts("x"), "yyyy-MM-dd HH:mm:ss.SSS")
    got = values(spark, texts, shown)
    text = eight.strftime("%Y-%m-%d %H:%M:%S")
    assert got == [f"{text}.000", f"{text}.000", f"{text}.000", f"{text}.250", f"{text}.000", f"{text}.000",
                   None, None, None, None]


def test_event_types_and_steps(spark):
    df = spark.createDataFrame(
        [("a",), (" Admission ",), ("DISCH",), ("t",), ("X",), (None,)], "event_type STRING"
    ).withColumn("event_type_std", adt.event_type_std())
    got = [(r.event_type_std, r.d) for r in df.withColumn("d", adt.census_delta()).collect()]
    assert got == [("ADMIT", 1), ("ADMIT", 1), ("DISCHARGE", -1), ("TRANSFER", 0), ("UNKNOWN", 0), ("UNKNOWN", 0)]


def test_payload_decode_never_raises(spark):
    df = spark.createDataFrame([("!!",), ("cGxhaW4",), ("eyJldmVudF90eXBlIjogIkEifQ==",)], "data STRING")
    out = df.select(adt.decode_payload().alias("t")).select("t", adt.parse_payload(F.col("t"))["event_type"].alias("e"))
    assert [tuple(r) for r in out.collect()] == [(None, None), ("plain", None), ('{"event_type": "A"}', "A")]
