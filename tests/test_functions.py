from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starward.functions import clock, codes, text
from starward.operators.setops import under_collation
from starward.plans import dimensions as D
from starward.schemas import OPERATIONAL
from starward.sources.generated import date_spine
from starward.sources.runlog import log_event, log_view, next_event
from starward.schemas import WAREHOUSE


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "email, marked",
    [
        ("a@b.com", "a@b.com"),
        ("a.b.com", "a.b.com (Invalid) "),
        ("a@b", "a@b (Invalid) "),
        (None, None),
        ("", " (Invalid) "),
    ],
)
def test_email_check(spark, email, marked):
    assert one(spark, email, "string", text.marked_email) == marked


def test_email_check_under_collation(spark):
    df = spark.createDataFrame([("A@B.COM",)], "v string")
    assert df.select(text.marked_email(F.col("v"))).first()[0] == "A@B.COM (Invalid) "
    lax = under_collation(df, "UTF8_LCASE").select(text.marked_email(F.col("v")))
    assert lax.first()[0] == "A@B.COM"


def test_deleted_marker_is_added_once(spark):
    assert one(spark, "Ann", "string", text.marked_deleted) == "Ann (Deleted)"
    assert one(spark, "Ann (Deleted)", "string", text.marked_deleted) == "Ann (Deleted)"


def test_joined_text_and_cuts(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(text.joined(F.col("x"), F.col("y"))).collect()] == ["a b", None]
    assert one(spark, "9800123", "string", lambda v: text.filled(v, "Check", 5)) == "98001"
    assert one(spark, None, "string", lambda v: text.filled(v, "Check", 5)) == "Check"


@pytest.mark.parametrize("number, clinic", [(100, 1), (200, 2), (300, 3), (400, None), (None, None)])
def test_clinic_decode(spark, number, clinic):
    assert one(spark, number, "int", codes.clinic_id) == clinic


def test_clinic_number_from_text(spark):
    assert one(spark, "3", "string", codes.clinic_number) == 300


def test_bad_number_text_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "x", "string", codes.clinic_number)


@pytest.mark.parametrize(
    "start, end, start24, end24, hours",
    [
        ("09:00:00", "05:00:00", "09:00:00", "17:00:00", 8),
        ("01:00:00", "21:00:00", "13:00:00", "21:00:00", 8),
        ("21:00:00", "09:00:00", "21:00:00", "09:00:00", 12),
        ("07:00:00", "10:00:00", "07:00:00", None, None),
    ],
)
def test_shift_clock_and_hours(spark, start, end, start24, end24, hours):
    df = spark.createDataFrame([(1, start, end)], OPERATIONAL["shifts"])
    row = D.dim_shifts_src(df).withColumn(
        "h", clock.hours_between(F.col("ShiftStart"), F.col("ShiftEnd"))
    ).first()
    assert (row.ShiftStart, row.ShiftEnd, row.h) == (start24, end24, hours)


def test_hours_over_midnight_count_the_long_way(spark):
    """A named limit: 22 to 06 is 8 hours of work but counts as 16."""
    df = spark.createDataFrame([("22:00:00", "06:00:00")], "a string, b string")
    assert df.select(clock.hours_between(F.col("a"), F.col("b"))).first()[0] == 16


@pytest.mark.parametrize("time, hour", [("9:00", 9), ("13:30", 13)])
def test_visit_time(spark, time, hour):
    got = one(spark, time, "string", lambda v: clock.visit_time(F.lit(date(2010, 1, 2)), v))
    assert got == datetime(2010, 1, 2, hour, 30 if hour == 13 else 0)


def test_calendar_row(spark):
    rows = D.dim_dates(spark).orderBy("FullDate")
    assert rows.first()[:] == (
        1,
        date(2005, 1, 1),
        "Saturday, 01-01-2005",
        200501,
        "January 2005",
        2005,
        "2005",
    )
    assert rows.count() == 2556


def test_calendar_length_and_number(spark):
    spine = date_spine(spark)
    assert spine.count() == 11323
    assert spine.agg(F.min("DateID"), F.max("DateID")).first()[:] == (19900101, 20201231)


def test_log_view_and_numbers(spark):
    empty = spark.createDataFrame([], WAREHOUSE["etl_log"])
    log = log_event(empty, "a", "first", datetime(2024, 3, 10, 19, 13))
    log = log_event(log, "b", "x" * 3000, datetime(2024, 3, 11, 9, 5))
    rows = log_view(log).orderBy("ETLLogID").collect()
    assert rows[0][:] == (1, "Sunday, March 10, 2024", "19:13", "a", "first")
    assert rows[1].ETLLogID == 2 and len(rows[1].ETLLogMessage) == 3000
    assert next_event(log, "c", "", datetime(2024, 1, 1)).first().ETLLogID == 3


def test_dimension_defaults(spark):
    clinics = spark.createDataFrame([(1, None, "a", "b", None, "98001-1234")], OPERATIONAL["clinics"])
    assert D.dim_clinics_src(clinics).first()[:] == (1, "Missing Data", "b", "Missing Data", "98001-1234")
    doctors = spark.createDataFrame(
        [(1, None, "Ng", None, "  Kent", "WA Redmond", "9800199")], OPERATIONAL["doctors"]
    )
    assert D.dim_doctors_src(doctors).first()[:] == (1, "Check", "Check", "  Kent", "WA Redmond", "98001")
    assert D.dim_doctors_src(doctors, clean=True).first()[3:5] == ("Kent", "WA")
    patients = spark.createDataFrame(
        [(7, "Al", "Bo", "e", "a", None, "WA", None)], OPERATIONAL["patients"]
    )
    assert D.dim_patients_src(patients).first()[:] == (7, "Al Bo", "Check", "WA", -1)
    procedures = spark.createDataFrame([(1, None, None, None)], OPERATIONAL["procedures"])
    assert D.dim_procedures_src(procedures).first()[:] == (1, "Check", "Check", None)
