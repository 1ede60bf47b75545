"""The clinic tables, told in terms of the test tables.

Regions are clinics, suppliers doctors, customers patients, parts procedures, line items visits,
events doctors' shifts.  ``WITH_MODEL`` says the same in SQL.  Defects are part of the mapping:
missing names, visits without a doctor, clinic numbers that decode to nothing, shifts of unknown
doctors.  Doctors are numbered from 1: 0 is the unknown member.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starward.catalog.registry import Tables
from starward.plans import dimensions as D
from starward.schemas import OPERATIONAL
from starward.sources.generated import date_spine, literal_rows

SHIFT_ROWS = [(1, "09:00:00", "05:00:00"), (2, "01:00:00", "21:00:00"), (3, "21:00:00", "09:00:00")]
# The days of the test tables: orders, and the events' month.
VISIT_DAYS = (date(1995, 1, 1), date(2001, 12, 31))
SHIFT_DAYS = (date(2024, 1, 1), date(2024, 12, 31))
ALL_DAYS = (VISIT_DAYS[0], SHIFT_DAYS[1])


def clinics(t: Tables) -> DataFrame:
    name = F.col("r_name")
    return t.region.select(
        (F.col("r_regionkey") + 1).alias("ClinicID"),
        F.nullif(name, F.lit("ASIA")).alias("ClinicName"),
        F.concat(name, F.lit(" Street")).alias("Address"),
        name.alias("City"),
        F.nullif(name, F.lit("EUROPE")).alias("State"),
        F.lpad(F.col("r_regionkey").cast("string"), 5, "98").alias("Zip"),
    )


def doctors(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        (F.col("s_suppkey") + 1).alias("DoctorID"),
        F.when(F.col("s_acctbal") >= 0, "Doctor").alias("FirstName"),
        F.col("s_name").alias("LastName"),
        F.concat(F.lower("s_name"), F.lit("@ward.com")).alias("EmailAddress"),
        F.concat(F.lit("  "), F.col("n_name")).alias("City"),
        F.when(F.col("s_acctbal") > 5000, "WA Redmond").otherwise("W A").alias("State"),
        F.lpad(F.col("n_nationkey").cast("string"), 7, "98").alias("Zip"),
    )


def patients(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select(
        F.col("c_custkey").alias("ID"),
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("FName"),
        F.col("c_name").alias("LName"),
        email().alias("Email"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St")).alias("Address"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("State"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") + 98000).alias("ZipCode"),
    )


def email():
    """Good, without an at sign, without the ending, or missing, by market segment."""
    at, com = F.lit("@ward"), F.lit(".com")
    return (
        F.when(F.col("c_mktsegment") == "FURNITURE", F.concat("c_name", com))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat("c_name", at))
        .when(F.col("c_mktsegment") != "BUILDING", F.concat("c_name", at, com))
    )


def procedures(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("ID"),
        F.col("p_name").alias("Name"),
        F.concat("p_brand", F.lit(" "), "p_type").alias("Desc"),
        F.col("p_retailprice").cast("decimal(19,4)").alias("Charge"),
    )


def visits(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("l_orderkey").alias("ID"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("Date"),
        (F.col("l_linenumber") * 100).alias("Clinic"),
        F.col("o_custkey").alias("Patient"),
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey") + 1).alias("Doctor"),
        F.col("l_partkey").alias("Procedure"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("Charge"),
    )


def doctor_shifts(t: Tables) -> DataFrame:
    kind, hour = F.col("event_type"), F.hour("ts")
    return t.events.select(
        F.col("event_id").alias("DoctorsShiftID"),
        F.to_date("ts").alias("ShiftDate"),
        F.when(kind == "click", 1)
        .when(kind == "view", 2)
        .when(kind == "purchase", 3)
        .when(kind == "signup", 4)
        .otherwise(9)
        .alias("ClinicID"),
        F.when(hour < 8, 1).when(hour < 16, 2).otherwise(3).alias("ShiftID"),
        (F.col("user_id") + 1).alias("DoctorID"),
    )


def shifts(t: Tables) -> DataFrame:
    return literal_rows(t.spark, SHIFT_ROWS, OPERATIONAL["shifts"])


def visit_spine(t: Tables) -> DataFrame:
    return date_spine(t.spark, *VISIT_DAYS)


def visit_dates(t: Tables) -> DataFrame:
    return D.dim_dates(t.spark, *VISIT_DAYS)


def shift_dates(t: Tables) -> DataFrame:
    return D.dim_dates(t.spark, *SHIFT_DAYS)


MODEL = """
clinics AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS ClinicID, nullif(r_name, 'ASIA') AS ClinicName,
    r_name || ' Street' AS Address, r_name AS City, nullif(r_name, 'EUROPE') AS State,
    lpad(CAST(r_regionkey AS VARCHAR), 5, '98') AS Zip
  FROM region),
doctors AS (
  SELECT s_suppkey + 1 AS DoctorID, CASE WHEN s_acctbal >= 0 THEN 'Doctor' END AS FirstName,
    s_name AS LastName, lower(s_name) || '@ward.com' AS EmailAddress, '  ' || n_name AS City,
    CASE WHEN s_acctbal > 5000 THEN 'WA Redmond' ELSE 'W A' END AS State,
    lpad(CAST(n_nationkey AS VARCHAR), 7, '98') AS Zip
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
patients AS (
  SELECT c_custkey AS ID, nullif(c_mktsegment, 'FURNITURE') AS FName, c_name AS LName,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name || '.com'
         WHEN c_mktsegment = 'MACHINERY' THEN c_name || '@ward'
         WHEN c_mktsegment <> 'BUILDING' THEN c_name || '@ward.com' END AS Email,
    CAST(c_custkey AS VARCHAR) || ' Main St' AS Address, n_name AS City, r_name AS State,
    CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey + 98000 END AS BIGINT) AS ZipCode
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
procedures AS (
  SELECT p_partkey AS ID, p_name AS Name, p_brand || ' ' || p_type AS "Desc",
    CAST(p_retailprice AS DECIMAL(19,4)) AS Charge
  FROM part),
visits AS (
  SELECT l_orderkey AS ID, o_orderdate + to_hours(CAST(l_linenumber AS BIGINT)) AS Date,
    CAST(l_linenumber * 100 AS BIGINT) AS Clinic, o_custkey AS Patient,
    CASE WHEN l_returnflag <> 'R' THEN l_suppkey + 1 END AS Doctor, l_partkey AS Procedure,
    CAST(l_extendedprice AS DECIMAL(19,4)) AS Charge
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
doctor_shifts AS (
  SELECT event_id AS DoctorsShiftID, CAST(ts AS DATE) AS ShiftDate,
    CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
      WHEN 'signup' THEN 4 ELSE 9 END AS BIGINT) AS ClinicID,
    CAST(CASE WHEN hour(ts) < 8 THEN 1 WHEN hour(ts) < 16 THEN 2 ELSE 3 END AS BIGINT) AS ShiftID,
    user_id + 1 AS DoctorID
  FROM events),
shifts AS (
  SELECT * FROM (VALUES (CAST(1 AS BIGINT), '09:00:00', '05:00:00'),
    (CAST(2 AS BIGINT), '01:00:00', '21:00:00'), (CAST(3 AS BIGINT), '21:00:00', '09:00:00'))
    AS v(ShiftID, ShiftStart, ShiftEnd)),
spine AS (
  SELECT CAST(day AS DATE) AS FullDate
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(day)),
clinics_src AS (
  SELECT ClinicID, coalesce(ClinicName, 'Missing Data') AS ClinicName,
    coalesce(City, 'Missing Data') AS ClinicCity, coalesce(State, 'Missing Data') AS ClinicState,
    coalesce(Zip, 'Missing Data') AS ClinicZip FROM clinics),
doctors_src AS (
  SELECT DoctorID, coalesce(FirstName || ' ' || LastName, 'Check') AS DoctorFullName,
    coalesce(EmailAddress, 'Check') AS DoctorEmailAddress, coalesce(City, 'Check') AS DoctorCity,
    coalesce(State, 'Check') AS DoctorState, substring(coalesce(Zip, 'Check'), 1, 5) AS DoctorZip
  FROM doctors),
patients_src AS (
  SELECT ID AS PatientID, coalesce(FName || ' ' || LName, 'Check') AS PatientFullName,
    coalesce(City, 'Check') AS PatientCity, coalesce(State, 'Check') AS PatientState,
    coalesce(ZipCode, -1) AS PatientZipCode FROM patients),
procedures_src AS (
  SELECT ID AS ProcedureID, coalesce(Name, 'Check') AS ProcedureName,
    coalesce("Desc", 'Check') AS ProcedureDesc, Charge AS ProcedureCharge FROM procedures),
shifts_src AS (
  SELECT ShiftID, CASE WHEN ShiftStart = '01:00:00' THEN '13:00:00' ELSE ShiftStart END AS ShiftStart,
    map {'05:00:00': '17:00:00', '21:00:00': '21:00:00', '09:00:00': '09:00:00'}[ShiftEnd] AS ShiftEnd
  FROM shifts),
dates_src AS (
  SELECT FullDate, strftime(FullDate, '%A, %m-%d-%Y') AS FullDateName,
    CAST(strftime(FullDate, '%Y%m') AS BIGINT) AS MonthID,
    strftime(FullDate, '%B %Y') AS MonthName, year(FullDate) AS YearID,
    strftime(FullDate, '%Y') AS YearName FROM spine),
dim_clinics AS (SELECT row_number() OVER (ORDER BY ClinicID) AS ClinicKey, * FROM clinics_src),
dim_doctors AS (SELECT row_number() OVER (ORDER BY DoctorID) AS DoctorKey, * FROM doctors_src),
dim_patients AS (SELECT row_number() OVER (ORDER BY PatientID) AS PatientKey, *,
    1 AS IsCurrent FROM patients_src),
dim_procedures AS (
  SELECT row_number() OVER (ORDER BY ProcedureID) AS ProcedureKey, * FROM procedures_src),
dim_shifts AS (SELECT row_number() OVER (ORDER BY ShiftID) AS ShiftKey, * FROM shifts_src),
dim_dates AS (SELECT row_number() OVER (ORDER BY FullDate) AS DateKey, * FROM dates_src),
coded_visits AS (
  SELECT ID AS VisitKey, CAST(Date AS DATE) AS FullDate, Clinic // 100 AS ClinicID,
    Patient AS PatientID, Doctor AS DoctorID, Procedure AS ProcedureID
  FROM visits WHERE Clinic IN (100, 200, 300)),
fact_visits AS (
  SELECT VisitKey, DateKey, ClinicKey, PatientKey, DoctorKey, ProcedureKey,
    sum(ProcedureCharge) AS ProcedureVistCharge
  FROM coded_visits JOIN dim_dates USING (FullDate) JOIN dim_clinics USING (ClinicID)
    JOIN dim_procedures USING (ProcedureID) JOIN dim_doctors USING (DoctorID)
    JOIN (SELECT * FROM dim_patients WHERE IsCurrent = 1) USING (PatientID)
  GROUP BY ALL)
"""


def with_model(body: str, extra: str = "") -> str:
    """``body`` with the mapped tables, and further tables in ``extra``, in scope."""
    return f"WITH {MODEL.strip()}{',' + extra if extra else ''}\n{body}"
