"""Source rows of the six dimensions: lazy frames over staged copies."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.functions import clock, codes
from starward.functions.text import cleaned_state, filled, joined, trimmed_city
from starward.sources.generated import date_spine

# Defaults for missing text, and the calendar range of the warehouse.
NO_CLINIC_TEXT = "Missing Data"
NO_TEXT = "Check"
NO_ZIP = -1
WAREHOUSE_DAYS = (date(2005, 1, 1), date(2011, 12, 31))

CLINIC = ["ClinicID", "ClinicName", "ClinicCity", "ClinicState", "ClinicZip"]
DOCTOR = [
    "DoctorID",
    "DoctorFullName",
    "DoctorEmailAddress",
    "DoctorCity",
    "DoctorState",
    "DoctorZip",
]
PATIENT = ["PatientID", "PatientFullName", "PatientCity", "PatientState", "PatientZipCode"]
PROCEDURE = ["ProcedureID", "ProcedureName", "ProcedureDesc", "ProcedureCharge"]
SHIFT = ["ShiftID", "ShiftStart", "ShiftEnd"]
DAY = ["FullDate", "FullDateName", "MonthID", "MonthName", "YearID", "YearName"]


def dim_clinics_src(clinics: DataFrame) -> DataFrame:
    """Zip is cut at 100 characters, not at the table's 5: the length check reports longer ones."""
    return clinics.select(
        "ClinicID",
        filled(F.col("ClinicName"), NO_CLINIC_TEXT, 100).alias("ClinicName"),
        filled(F.col("City"), NO_CLINIC_TEXT, 100).alias("ClinicCity"),
        filled(F.col("State"), NO_CLINIC_TEXT, 100).alias("ClinicState"),
        filled(F.col("Zip"), NO_CLINIC_TEXT, 100).alias("ClinicZip"),
    )


def dim_doctors_src(doctors: DataFrame, clean: bool = False) -> DataFrame:
    """``clean`` trims the city and tidies the state, as the first version of the load did."""
    city, state = F.col("City"), F.col("State")
    if clean:
        city, state = trimmed_city(city), cleaned_state(state)
    return doctors.select(
        "DoctorID",
        filled(joined(F.col("FirstName"), F.col("LastName")), NO_TEXT, 200).alias("DoctorFullName"),
        filled(F.col("EmailAddress"), NO_TEXT, 100).alias("DoctorEmailAddress"),
        filled(city, NO_TEXT, 100).alias("DoctorCity"),
        filled(state, NO_TEXT, 100).alias("DoctorState"),
        filled(F.col("Zip"), NO_TEXT, 5).alias("DoctorZip"),
    )


def dim_patients_src(patients: DataFrame) -> DataFrame:
    return patients.select(
        F.col("ID").alias("PatientID"),
        filled(joined(F.col("FName"), F.col("LName")), NO_TEXT, 100).alias("PatientFullName"),
        filled(F.col("City"), NO_TEXT, 100).alias("PatientCity"),
        filled(F.col("State"), NO_TEXT, 100).alias("PatientState"),
        F.coalesce(F.col("ZipCode"), F.lit(NO_ZIP)).cast("int").alias("PatientZipCode"),
    )


def dim_procedures_src(procedures: DataFrame) -> DataFrame:
    """A missing charge stays NULL; the not-null check reports it."""
    return procedures.select(
        F.col("ID").alias("ProcedureID"),
        filled(F.col("Name"), NO_TEXT, 100).alias("ProcedureName"),
        filled(F.col("Desc"), NO_TEXT, 1000).alias("ProcedureDesc"),
        F.col("Charge").cast("decimal(19,4)").alias("ProcedureCharge"),
    )


def dim_shifts_src(shifts: DataFrame) -> DataFrame:
    return shifts.select(
        "ShiftID",
        codes.shift_start(F.col("ShiftStart")).alias("ShiftStart"),
        codes.shift_end(F.col("ShiftEnd")).alias("ShiftEnd"),
    )


def dim_dates_src(
    spine: DataFrame, lo: date = WAREHOUSE_DAYS[0], hi: date = WAREHOUSE_DAYS[1]
) -> DataFrame:
    """Calendar columns for the days from ``lo`` to ``hi``, both included."""
    day = F.col("FullDate")
    return spine.where(day.between(F.lit(lo), F.lit(hi))).select(
        "FullDate",
        clock.full_date_name(day).alias("FullDateName"),
        clock.month_id(day).alias("MonthID"),
        clock.month_name(day).alias("MonthName"),
        F.year(day).alias("YearID"),
        clock.year_name(day).alias("YearName"),
    )


def dim_dates(
    spark: SparkSession, lo: date = WAREHOUSE_DAYS[0], hi: date = WAREHOUSE_DAYS[1]
) -> DataFrame:
    """First fill of the date dimension: every day from ``lo`` to ``hi``.

    The calendar is made here and has no gaps, so a day's rank is its distance from ``lo``: keys need no sort.
    """
    key = (F.datediff(F.col("FullDate"), F.lit(lo)) + 1).cast("bigint").alias("DateKey")
    return dim_dates_src(date_spine(spark, lo, hi), lo, hi).select(key, *DAY)


def with_unknown_member(dim: DataFrame, row: Sequence, schema: T.StructType | None = None) -> DataFrame:
    """The dimension plus the member that stands for "none"."""
    member = dim.sparkSession.createDataFrame([tuple(row)], schema or dim.schema)
    return dim.unionByName(member)
