"""Projections, predicates and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starward.catalog import model as M
from starward.catalog.model import with_model
from starward.catalog.registry import query
from starward.functions import clock, codes, text
from starward.operators.setops import change_set
from starward.plans.file_load import flag_invalid_email

c = F.col


@query(
    "p1_rename",
    with_model('SELECT ID AS ProcedureID, Name AS ProcedureName, "Desc" AS ProcedureDesc FROM procedures'),
)
def _(t):
    return M.procedures(t).select(
        c("ID").alias("ProcedureID"), c("Name").alias("ProcedureName"), c("Desc").alias("ProcedureDesc")
    )


@query(
    "p2_constant",
    "SELECT o_orderkey, CAST(100 AS BIGINT) AS Clinic, CAST(1 AS BIGINT) AS IsCurrent, "
    "CAST(NULL AS VARCHAR) AS EndDate FROM orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.lit(100).alias("Clinic"),
        F.lit(1).alias("IsCurrent"),
        F.lit(None).cast("date").alias("EndDate"),
    )


@query(
    "p3_text_arithmetic",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 100 AS Clinic FROM lineitem",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey", codes.clinic_number(c("l_linenumber").cast("string")).alias("Clinic")
    )


@query(
    "p4_code_map",
    with_model(
        "SELECT Clinic, CAST(CASE WHEN Clinic IN (100, 200, 300) THEN Clinic // 100 END AS BIGINT) "
        "AS ClinicID, count(*) AS n FROM visits GROUP BY ALL"
    ),
)
def _(t):
    visits = M.visits(t).select("Clinic", codes.clinic_id(c("Clinic")).alias("ClinicID"))
    return visits.groupBy("Clinic", "ClinicID").agg(F.count("*").alias("n"))


def _clock_text(t):
    """The hour of each event as a shift text."""
    return t.events.select("event_id", F.date_format("ts", "HH:00:00").alias("hh"))


@query(
    "p5_code_map_keep",
    "SELECT event_id, CASE hh WHEN '01:00:00' THEN '13:00:00' ELSE hh END AS ShiftStart "
    "FROM (SELECT event_id, strftime(ts, '%H:00:00') AS hh FROM events)",
)
def _(t):
    return _clock_text(t).select("event_id", codes.shift_start(c("hh")).alias("ShiftStart"))


@query(
    "p6_code_map_null",
    "SELECT event_id, CASE hh WHEN '05:00:00' THEN '17:00:00' WHEN '21:00:00' THEN '21:00:00' "
    "WHEN '09:00:00' THEN '09:00:00' END AS ShiftEnd "
    "FROM (SELECT event_id, strftime(ts, '%H:00:00') AS hh FROM events)",
)
def _(t):
    return _clock_text(t).select("event_id", codes.shift_end(c("hh")).alias("ShiftEnd"))


@query(
    "p7_conditional_update",
    with_model(
        "SELECT ID, CASE WHEN instr(Email, '@') = 0 OR instr(Email, '.com') = 0 "
        "THEN Email || ' (Invalid) ' ELSE Email END AS Email FROM patients"
    ),
)
def _(t):
    return flag_invalid_email(M.patients(t)).select("ID", "Email")


@query(
    "p8_inline_if",
    "SELECT c_custkey, CASE WHEN instr(name, '(Deleted)') > 0 THEN name ELSE name || ' (Deleted)' END AS name "
    "FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name || ' (Deleted)' ELSE c_name END AS name "
    "FROM customer)",
)
def _(t):
    once = F.when(c("c_acctbal") < 0, F.concat("c_name", F.lit(text.DELETED))).otherwise(c("c_name"))
    return t.customer.select("c_custkey", once.alias("name")).select(
        "c_custkey", text.marked_deleted(c("name")).alias("name")
    )


@query("p9_equality_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.where(c("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query(
    "p10_range_filter",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS DateID FROM orders "
    "WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate <= DATE '1998-12-31'",
)
def _(t):
    """The range is put on the stored column, so it reaches the scan."""
    day = c("o_orderdate")
    lo, hi = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz")
    return t.orders.where(day.between(lo, hi)).select("o_orderkey", clock.date_id(day).alias("DateID"))


@query(
    "p11_or_of_absent",
    with_model("SELECT ID, Email FROM patients WHERE instr(Email, '@') = 0 OR instr(Email, '.com') = 0"),
)
def _(t):
    return (
        M.patients(t)
        .where(text.lacks(c("Email"), "@") | text.lacks(c("Email"), ".com"))
        .select("ID", "Email")
    )


@query(
    "p12_null_replacement",
    with_model(
        "SELECT ID, coalesce(FName, 'Check') AS FName, coalesce(ZipCode, -1) AS ZipCode FROM patients"
    ),
)
def _(t):
    return M.patients(t).select(
        "ID",
        text.filled(c("FName"), "Check").alias("FName"),
        F.coalesce(c("ZipCode"), F.lit(-1)).alias("ZipCode"),
    )


@query("p13_length_cast", with_model("SELECT DoctorID, substring(Zip, 1, 5) AS Zip FROM doctors"))
def _(t):
    return M.doctors(t).select("DoctorID", text.filled(c("Zip"), "Check", 5).alias("Zip"))


@query(
    "p14_named_subquery",
    "WITH Changed AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT "
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice < 100000) "
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM Changed)",
)
def _(t):
    cols = ["o_orderkey", "o_custkey"]
    orders = t.orders
    changed = change_set(
        orders.where("o_orderstatus = 'O'"), orders.where("o_totalprice < 100000"), cols
    ).where("in_source = 1")
    return orders.join(changed.select("o_orderkey"), "o_orderkey", "left_semi").select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "p15_star_plus_computed",
    with_model(
        "SELECT DoctorsShiftID, CAST(ShiftDate AS VARCHAR) AS ShiftDate, ClinicID, ShiftID, DoctorID, "
        "strftime(ShiftDate, '%Y%m') || '-' || CAST(ClinicID AS VARCHAR) AS MonthAndClinic FROM doctor_shifts"
    ),
)
def _(t):
    extra = F.concat_ws("-", F.date_format("ShiftDate", "yyyyMM"), c("ClinicID").cast("string"))
    return M.doctor_shifts(t).select("*", extra.alias("MonthAndClinic"))


# --- scalar functions --------------------------------------------------------------------------


@query("f1_joined_text", with_model("SELECT ID, FName || ' ' || LName AS FullName FROM patients"))
def _(t):
    return M.patients(t).select("ID", text.joined(c("FName"), c("LName")).alias("FullName"))


@query("f2_isnull", with_model("SELECT ClinicID, coalesce(ClinicName, 'Missing Data') AS ClinicName FROM clinics"))
def _(t):
    return M.clinics(t).select("ClinicID", text.filled(c("ClinicName"), "Missing Data").alias("ClinicName"))


@query(
    "f3_pattern_position",
    with_model("SELECT ID, CAST(instr(Email, '@') AS BIGINT) AS at, CAST(instr(Email, '.com') = 0 AS BIGINT) AS lacks_com FROM patients"),
)
def _(t):
    return M.patients(t).select(
        "ID", F.instr("Email", "@").alias("at"), text.lacks(c("Email"), ".com").alias("lacks_com")
    )


@query("f4_ltrim", with_model("SELECT DoctorID, ltrim(City) AS City FROM doctors"))
def _(t):
    return M.doctors(t).select("DoctorID", text.trimmed_city(c("City")).alias("City"))


@query(
    "f5_nested_replace",
    with_model("SELECT DoctorID, replace(replace(State, ' ', ''), 'Redmond', '') AS State FROM doctors"),
)
def _(t):
    return M.doctors(t).select("DoctorID", text.cleaned_state(c("State")).alias("State"))


@query("f6_month_number", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS MonthID FROM orders")
def _(t):
    return t.orders.select("o_orderkey", clock.month_id(c("o_orderdate")).alias("MonthID"))


@query(
    "f7_casts",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS at, "
    "CAST(o_custkey AS BIGINT) AS patient, CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS charge "
    "FROM orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        c("o_orderdate").cast("timestamp_ntz").alias("at"),
        c("o_custkey").cast("string").cast("int").alias("patient"),
        c("o_totalprice").cast("decimal(19,4)").alias("charge"),
    )


@query(
    "f8_date_plus_time",
    "SELECT o_orderkey, strftime(o_orderdate + to_hours(9 + o_custkey % 9) + INTERVAL 30 MINUTE, "
    "'%Y-%m-%d %H:%M:%S') AS Date FROM orders",
)
def _(t):
    hour = (c("o_custkey") % 9 + 9).cast("string")
    return t.orders.select(
        "o_orderkey",
        clock.visit_time(c("o_orderdate"), F.concat(hour, F.lit(":30"))).alias("Date"),
    )


@query("f9_date_number", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS DateID FROM orders")
def _(t):
    return t.orders.select("o_orderkey", clock.date_id(c("o_orderdate")).alias("DateID"))


@query("f10_us_date", "SELECT event_id, strftime(ts, '%m-%d-%Y') AS day FROM events")
def _(t):
    return t.events.select("event_id", F.date_format("ts", "MM-dd-yyyy").alias("day"))


@query("f11_weekday", "SELECT event_id, strftime(ts, '%A') AS weekday FROM events")
def _(t):
    return t.events.select("event_id", F.date_format("ts", "EEEE").alias("weekday"))


@query("f12_month_name", "SELECT o_orderkey, strftime(o_orderdate, '%B %Y') AS MonthName FROM orders")
def _(t):
    return t.orders.select("o_orderkey", clock.month_name(c("o_orderdate")).alias("MonthName"))


@query(
    "f13_year",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS YearID, strftime(o_orderdate, '%Y') AS YearName FROM orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("YearID"),
        clock.year_name(c("o_orderdate")).alias("YearName"),
    )


@query("f14_next_day", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.date_add("o_orderdate", 1).alias("next_day"))


@query("f15_hour_difference", "SELECT event_id, CAST(21 - hour(ts) AS BIGINT) AS hours FROM events")
def _(t):
    """Boundaries from an event's hour to 21:00, with sign."""
    return t.events.select("event_id", (F.lit(21) - F.hour("ts")).alias("hours"))


@query("f16_abs", "SELECT event_id, CAST(abs(9 - hour(ts)) AS BIGINT) AS hours FROM events")
def _(t):
    return t.events.select(
        "event_id", clock.hours_between(F.lit("09:00:00"), F.date_format("ts", "HH:mm:ss")).alias("hours")
    )


@query("f17_as_of", "SELECT c_custkey, '2010-01-02' AS StartDate FROM customer")
def _(t):
    """The day is an argument of the job and never read from the clock."""
    return t.customer.select("c_custkey", F.lit("2010-01-02").cast("date").alias("StartDate"))


@query(
    "f18_long_format",
    "SELECT event_id, strftime(ts, '%A, %B ') || CAST(day(ts) AS VARCHAR) || strftime(ts, ', %Y') AS ETLDate, "
    "strftime(ts, '%H:%M') AS ETLTime FROM events",
)
def _(t):
    return t.events.select(
        "event_id", clock.long_date(c("ts")).alias("ETLDate"), clock.short_time(c("ts")).alias("ETLTime")
    )


@query(
    "f19_marker",
    "SELECT c_custkey, c_name || ' (Deleted)' AS deleted, c_name || ' (Invalid) ' AS invalid FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        text.marked_deleted(c("c_name")).alias("deleted"),
        text.marked_email(c("c_name")).alias("invalid"),
    )
