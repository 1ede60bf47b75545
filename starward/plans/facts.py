"""Source rows of the two fact tables: natural IDs replaced by surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starward.functions.clock import hours_between
from starward.functions.codes import clinic_id
from starward.operators.lookup import lookup_key
from starward.sources.ledger import LossLedger, watched

SHIFT_FACT = ["DoctorsShiftID", "ShiftDateKey", "ClinicKey", "ShiftKey", "DoctorKey", "HoursWorked"]
VISIT_FACT = [
    "VisitKey",
    "DateKey",
    "ClinicKey",
    "PatientKey",
    "DoctorKey",
    "ProcedureKey",
    "ProcedureVistCharge",
]


def fact_shifts_src(
    doctor_shifts: DataFrame,
    dates: DataFrame,
    clinics: DataFrame,
    shifts: DataFrame,
    doctors: DataFrame,
    unknown: str = "drop",
    month: bool = False,
    ledger: LossLedger | None = None,
) -> DataFrame:
    """One row per doctor's shift.  Hours come from the dimension's 24-hour texts.

    ``month`` adds the day's ``MonthID``, by which the fact is stored; ``ledger`` counts the rows before and after each lookup.
    """
    of_day = ["DateKey", "MonthID"] if month else ["DateKey"]
    rows = watched(ledger, doctor_shifts, "read")
    rows = watched(ledger, lookup_key(rows, dates, F.col("ShiftDate"), "FullDate", of_day), "dim_dates")
    rows = watched(ledger, lookup_key(rows, clinics, F.col("ClinicID"), "ClinicID", ["ClinicKey"]), "dim_clinics")
    rows = lookup_key(
        rows, shifts, F.col("ShiftID"), "ShiftID", ["ShiftKey", "ShiftStart", "ShiftEnd"]
    )
    rows = watched(ledger, rows, "dim_shifts")
    rows = lookup_key(rows, doctors, F.col("DoctorID"), "DoctorID", ["DoctorKey"], unknown)
    rows = watched(ledger, rows, "dim_doctors")
    return rows.select(
        *of_day[1:],
        "DoctorsShiftID",
        F.col("DateKey").alias("ShiftDateKey"),
        "ClinicKey",
        "ShiftKey",
        "DoctorKey",
        "ShiftStart",
        "ShiftEnd",
        hours_between(F.col("ShiftStart"), F.col("ShiftEnd")).alias("HoursWorked"),
    )


def fact_visits_src(
    visits: DataFrame,
    dates: DataFrame,
    clinics: DataFrame,
    patients: DataFrame,
    doctors: DataFrame,
    procedures: DataFrame,
    unknown: str = "drop",
    month: bool = False,
    ledger: LossLedger | None = None,
) -> DataFrame:
    """One row per visit and set of keys.  The charge is the procedure's list price, summed.

    Only current patients count, so after a change all of a patient's visits point to the newest
    version.  ``unknown="drop"`` loses visits without a known doctor; ``"member"`` keeps them
    under key 0.

    Small dimensions come first: they are joined in place and drop rows before the patients,
    which may be large enough to need a shuffle.  The patient's ID is carried into the grouping,
    where it changes nothing because a key has one ID; it lets the grouping use that shuffle.

    ``month`` adds the day's ``MonthID``, by which the fact is stored; ``ledger`` counts the rows before and after each lookup.
    """
    of_day = ["DateKey", "MonthID"] if month else ["DateKey"]
    rows = watched(ledger, visits, "read").select(
        F.col("ID").alias("VisitKey"),
        F.to_date("Date").alias("_day"),
        clinic_id(F.col("Clinic")).alias("_clinic"),
        "Patient",
        F.col("Doctor").alias("_doctor"),
        F.col("Procedure").alias("_procedure"),
    )
    current = patients.where(F.col("IsCurrent") == 1)
    rows = watched(ledger, lookup_key(rows, dates, F.col("_day"), "FullDate", of_day), "dim_dates")
    rows = watched(ledger, lookup_key(rows, clinics, F.col("_clinic"), "ClinicID", ["ClinicKey"]), "dim_clinics")
    rows = lookup_key(
        rows, procedures, F.col("_procedure"), "ProcedureID", ["ProcedureKey", "ProcedureCharge"]
    )
    rows = watched(ledger, rows, "dim_procedures")
    rows = lookup_key(rows, doctors, F.col("_doctor"), "DoctorID", ["DoctorKey"], unknown)
    rows = watched(ledger, rows, "dim_doctors")
    rows = watched(ledger, lookup_key(rows, current, F.col("Patient"), "PatientID", ["PatientKey"]), "dim_patients")
    keys = ["VisitKey", *of_day, "ClinicKey", "PatientKey", "DoctorKey", "ProcedureKey"]
    charge = F.sum("ProcedureCharge").cast("decimal(19,4)").alias("ProcedureVistCharge")
    return rows.groupBy("Patient", *keys).agg(charge).select(*of_day[1:], *VISIT_FACT)
