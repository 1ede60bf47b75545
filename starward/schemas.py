"""Declared schemas: daily files, operational tables, warehouse tables.

Column names and types are fixed values shared with the systems that write and read these tables.
Surrogate keys and visit numbers are ``bigint`` so that they do not run out.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": T.DecimalType(19, 4),
}


def _schema(columns: str) -> T.StructType:
    """``"name type, name type"``; needs no session, unlike a DDL string."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PATIENT_COLUMNS = ["FName", "LName", "Email", "Address", "City", "State", "ZipCode"]
VISIT_COLUMNS = ["Date", "Clinic", "Patient", "Doctor", "Procedure", "Charge"]

# The columns of each clinic's file, in file order; everything arrives as text.
FEED_SCHEMAS: dict[tuple[str, str], T.StructType] = {
    ("Bellevue", "NewPatients"): _text(*PATIENT_COLUMNS),
    ("Kirkland", "NewPatients"): _text(*PATIENT_COLUMNS),
    ("Redmond", "NewPatients"): _text(*PATIENT_COLUMNS),
    ("Bellevue", "Visits"): _text("Time", "Patient", "Doctor", "Procedure", "Charge"),
    ("Kirkland", "Visits"): _text("Time", "Patient", "Clinic", "Doctor", "Procedure", "Charge"),
    ("Redmond", "Visits"): _text("Time", "Clinic", "Patient", "Doctor", "Procedure", "Charge"),
}

CLINICS = ("Bellevue", "Kirkland", "Redmond")
KINDS = ("NewPatients", "Visits")

# Fixed value: Bellevue sends no clinic number; its rows belong to operational clinic 100.
CLINIC_WITHOUT_NUMBER = 100

#: One shape for all three files of a kind, reached by name and not by position.
CONFORMED = {
    "NewPatients": _text(*PATIENT_COLUMNS),
    "Visits": _text("Time", "Clinic", "Patient", "Doctor", "Procedure", "Charge"),
}

OPERATIONAL = {
    "patients": _schema(
        "ID bigint, FName string, LName string, Email string, Address string, City string, "
        "State string, ZipCode int"
    ),
    "visits": _schema(
        "ID bigint, Date timestamp_ntz, Clinic int, Patient bigint, Doctor bigint, "
        "Procedure bigint, Charge money"
    ),
    "procedures": _schema("ID bigint, Name string, Desc string, Charge money"),
    "clinics": _schema(
        "ClinicID int, ClinicName string, Address string, City string, State string, Zip string"
    ),
    "doctors": _schema(
        "DoctorID bigint, FirstName string, LastName string, EmailAddress string, City string, "
        "State string, Zip string"
    ),
    "shifts": _schema("ShiftID int, ShiftStart string, ShiftEnd string"),
    "doctor_shifts": _schema(
        "DoctorsShiftID bigint, ShiftDate date, ClinicID int, ShiftID int, DoctorID bigint"
    ),
}

WAREHOUSE = {
    "dim_dates": _schema(
        "DateKey bigint, FullDate date, FullDateName string, MonthID int, MonthName string, "
        "YearID int, YearName string"
    ),
    "dim_clinics": _schema(
        "ClinicKey bigint, ClinicID int, ClinicName string, ClinicCity string, "
        "ClinicState string, ClinicZip string"
    ),
    "dim_doctors": _schema(
        "DoctorKey bigint, DoctorID bigint, DoctorFullName string, DoctorEmailAddress string, "
        "DoctorCity string, DoctorState string, DoctorZip string"
    ),
    "dim_shifts": _schema("ShiftKey bigint, ShiftID int, ShiftStart string, ShiftEnd string"),
    "dim_procedures": _schema(
        "ProcedureKey bigint, ProcedureID bigint, ProcedureName string, ProcedureDesc string, "
        "ProcedureCharge money"
    ),
    "dim_patients": _schema(
        "PatientKey bigint, PatientID bigint, PatientFullName string, PatientCity string, "
        "PatientState string, PatientZipCode int, StartDate date, EndDate date, IsCurrent int"
    ),
    "fact_doctor_shifts": _schema(
        "DoctorsShiftID bigint, ShiftDateKey bigint, ClinicKey bigint, ShiftKey bigint, "
        "DoctorKey bigint, HoursWorked int"
    ),
    "fact_visits": _schema(
        "VisitKey bigint, DateKey bigint, ClinicKey bigint, PatientKey bigint, "
        "DoctorKey bigint, ProcedureKey bigint, ProcedureVistCharge money"
    ),
    "etl_log": _schema(
        "ETLLogID bigint, ETLDateAndTime timestamp_ntz, ETLAction string, ETLLogMessage string"
    ),
}

# The member that stands for "no doctor recorded".
UNKNOWN_DOCTOR = (0, 0, "Unknown", "Unknown", "Unknown", "Unknown", "00000")
