"""Warehouse operators: keys, syncs, merges, transforms, checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starward.catalog import model as M
from starward.catalog.model import with_model
from starward.catalog.registry import query
from starward.catalog.relations import shift_facts, shift_facts_sql, visit_facts
from starward.operators import quality
from starward.operators.history import scd2_merge
from starward.operators.keys import assign_keys
from starward.operators.merge import fact_merge
from starward.operators.reconcile import reconcile
from starward.operators.sync import scd1_sync
from starward.plans import dimensions as D
from starward.plans.file_load import flag_invalid_email, new_patients, new_visits, visit_rows
from starward.schemas import UNKNOWN_DOCTOR, WAREHOUSE

c = F.col


# --- keys and syncs ----------------------------------------------------------------------------


@query(
    "w1_keys",
    "SELECT 100 + row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS PatientKey, c_custkey FROM customer",
)
def _(t):
    rows = t.customer.select("c_mktsegment", "c_custkey")
    keyed = assign_keys(rows, "PatientKey", ["c_mktsegment", "c_custkey"], start=100, unique=True)
    return keyed.drop("c_mktsegment")


@query(
    "w1_keys_with_ties",
    "SELECT c_mktsegment, min(k) AS lowest, max(k) AS highest, count(*) AS n FROM "
    "(SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS k FROM customer) GROUP BY 1",
)
def _(t):
    """Five order values over the whole table; which row of a tie gets which key is open."""
    keyed = assign_keys(t.customer.select("c_mktsegment"), "k", ["c_mktsegment"])
    return keyed.groupBy("c_mktsegment").agg(
        F.min("k").alias("lowest"), F.max("k").alias("highest"), F.count("*").alias("n")
    )


def _scd1_sql(key: str, columns: list[str], name: str | None) -> str:
    """Type 1 sync of ``old`` with ``src`` by sets; ``name`` is None for a hard delete."""
    cols, nid = ", ".join(columns), columns[0]
    head = f"""
  ids AS (SELECT DISTINCT {nid} AS i FROM (SELECT {cols} FROM src EXCEPT SELECT {cols} FROM old)),
  kept AS (SELECT * FROM old WHERE {nid} NOT IN (SELECT i FROM ids)),
  added AS (SELECT (SELECT max({key}) FROM old) + row_number() OVER (ORDER BY {nid}) AS {key}, {cols}
    FROM src WHERE {nid} IN (SELECT i FROM ids)),
  now AS (SELECT {key}, {cols} FROM kept UNION ALL SELECT {key}, {cols} FROM added),
  gone AS (SELECT DISTINCT {nid} AS i FROM (SELECT {cols} FROM now EXCEPT SELECT {cols} FROM src)),
  state AS """
    if name is None:
        return head + f"(SELECT * FROM now WHERE {nid} NOT IN (SELECT i FROM gone))"
    marked = (
        f"CASE WHEN {nid} IN (SELECT i FROM gone) AND instr({name}, '(Deleted)') = 0 "
        f"THEN {name} || ' (Deleted)' ELSE {name} END AS {name}"
    )
    out = ", ".join(marked if x == name else x for x in columns)
    return head + f"(SELECT {key}, {out} FROM now)"


_DOCTORS = """
  src AS (SELECT * FROM doctors_src WHERE DoctorCity <> '  NATION_7'),
  old AS (SELECT DoctorID + 1 AS DoctorKey, DoctorID, DoctorFullName, DoctorEmailAddress, DoctorCity,
      CASE WHEN DoctorCity = '  NATION_5' THEN 'OR' ELSE DoctorState END AS DoctorState, DoctorZip
    FROM doctors_src WHERE DoctorCity <> '  NATION_3'),
"""


def doctors_before_and_now(t):
    """Since the last load one town's doctors left, one town's came, one town's changed state."""
    now, city = D.dim_doctors_src(M.doctors(t)), c("DoctorCity")
    old = now.where(city != "  NATION_3").select(
        (c("DoctorID") + 1).alias("DoctorKey"),
        *D.DOCTOR[:4],
        F.when(city == "  NATION_5", "OR").otherwise(c("DoctorState")).alias("DoctorState"),
        "DoctorZip",
    )
    return old, now.where(city != "  NATION_7")


@query(
    "w2_scd1_flag",
    with_model("SELECT * FROM state", _DOCTORS + _scd1_sql("DoctorKey", D.DOCTOR, "DoctorFullName")),
)
def _(t):
    old, now = doctors_before_and_now(t)
    return scd1_sync(
        old, now, "DoctorID", D.DOCTOR, "DoctorKey", name_column="DoctorFullName", unique=True
    )


@query(
    "w2_scd1_keep_keys",
    with_model(
        "SELECT coalesce(o.DoctorKey, s.DoctorKey - (SELECT count(*) FROM state x JOIN old y ON "
        "x.DoctorID = y.DoctorID WHERE x.DoctorKey <> y.DoctorKey AND x.DoctorID < s.DoctorID)) AS DoctorKey, "
        "s.DoctorID, s.DoctorFullName, s.DoctorState FROM state s LEFT JOIN old o ON s.DoctorID = o.DoctorID",
        _DOCTORS + _scd1_sql("DoctorKey", D.DOCTOR, "DoctorFullName"),
    ),
)
def _(t):
    """Changed doctors keep their keys; only the new ones are numbered."""
    old, now = doctors_before_and_now(t)
    state = scd1_sync(
        old,
        now,
        "DoctorID",
        D.DOCTOR,
        "DoctorKey",
        name_column="DoctorFullName",
        on_update="keep",
        unique=True,
    )
    return state.select("DoctorKey", "DoctorID", "DoctorFullName", "DoctorState")


@query(
    "w3_scd1_drop",
    with_model(
        "SELECT * REPLACE (CAST(ProcedureCharge AS DOUBLE) AS ProcedureCharge) FROM state",
        "src AS (SELECT * FROM procedures_src WHERE NOT ends_with(ProcedureDesc, 'STANDARD')), "
        "old AS (SELECT ProcedureID + 1 AS ProcedureKey, ProcedureID, ProcedureName, ProcedureDesc, "
        "CAST(CASE WHEN ends_with(ProcedureDesc, 'PROMO') THEN ProcedureCharge + 1 ELSE ProcedureCharge END "
        "AS DECIMAL(19,4)) AS ProcedureCharge FROM procedures_src WHERE NOT ends_with(ProcedureDesc, 'LARGE')),"
        + _scd1_sql("ProcedureKey", D.PROCEDURE, None),
    ),
)
def _(t):
    now, desc = D.dim_procedures_src(M.procedures(t)), c("ProcedureDesc")
    price = F.when(desc.endswith("PROMO"), c("ProcedureCharge") + 1).otherwise(c("ProcedureCharge"))
    old = now.where(~desc.endswith("LARGE")).select(
        (c("ProcedureID") + 1).alias("ProcedureKey"),
        *D.PROCEDURE[:3],
        price.cast("decimal(19,4)").alias("ProcedureCharge"),
    )
    source = now.where(~desc.endswith("STANDARD"))
    return scd1_sync(
        old, source, "ProcedureID", D.PROCEDURE, "ProcedureKey", on_delete="drop", unique=True
    )


_PATIENTS = """
  src AS (SELECT * FROM patients_src WHERE PatientState <> 'AFRICA'),
  old AS (
    SELECT 2 * PatientID + 1 AS PatientKey, PatientID, PatientFullName,
      CASE WHEN PatientState = 'EUROPE' THEN 'Old Town' ELSE PatientCity END AS PatientCity,
      PatientState, PatientZipCode, '2009-07-01' AS StartDate, CAST(NULL AS VARCHAR) AS EndDate,
      CAST(1 AS BIGINT) AS IsCurrent
    FROM patients_src WHERE PatientState <> 'ASIA'
    UNION ALL
    SELECT 2 * PatientID + 2, PatientID, PatientFullName, 'Older Town', PatientState, PatientZipCode,
      '2008-01-01', '2009-06-30', 0
    FROM patients_src WHERE PatientState = 'AMERICA'),
"""


def _scd2_sql(reclose: bool) -> str:
    cols = ["PatientID", "PatientFullName", "PatientCity", "PatientState", "PatientZipCode"]
    same = " AND ".join(f"o.{x} = s.{x}" for x in cols)
    match = f"(o.IsCurrent = 1 AND EXISTS (SELECT 1 FROM src s WHERE {same}))"
    stays = match if reclose else f"({match} OR o.IsCurrent = 0)"
    return f"""
  state AS (
    SELECT o.PatientKey, {', '.join('o.' + x for x in cols)}, o.StartDate,
      CASE WHEN {stays} THEN o.EndDate ELSE '2010-01-02' END AS EndDate,
      CASE WHEN {stays} THEN o.IsCurrent ELSE 0 END AS IsCurrent
    FROM old o
    UNION ALL
    SELECT (SELECT max(PatientKey) FROM old) + row_number() OVER (ORDER BY s.PatientID),
      {', '.join('s.' + x for x in cols)}, '2010-01-02', NULL, 1
    FROM src s WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.IsCurrent = 1 AND {same}))"""


def _patients_before_and_now(t):
    """One state's patients left, one state's came, one state's moved, one state's moved before."""
    now, state = D.dim_patients_src(M.patients(t)), c("PatientState")

    def version(rows, key, city, start, end, current):
        return rows.select(
            key.alias("PatientKey"),
            "PatientID",
            "PatientFullName",
            city.alias("PatientCity"),
            "PatientState",
            "PatientZipCode",
            F.lit(start).cast("date").alias("StartDate"),
            F.lit(end).cast("date").alias("EndDate"),
            F.lit(current).alias("IsCurrent"),
        )

    moved = F.when(state == "EUROPE", "Old Town").otherwise(c("PatientCity"))
    old = version(
        now.where(state != "ASIA"), 2 * c("PatientID") + 1, moved, "2009-07-01", None, 1
    ).unionByName(
        version(
            now.where(state == "AMERICA"),
            2 * c("PatientID") + 2,
            F.lit("Older Town"),
            "2008-01-01",
            "2009-06-30",
            0,
        )
    )
    return old, now.where(state != "AFRICA")


@query("w4_scd2_merge", with_model("SELECT * FROM state", _PATIENTS + _scd2_sql(True)))
def _(t):
    old, now = _patients_before_and_now(t)
    return scd2_merge(old, now, D.PATIENT, "PatientKey", date(2010, 1, 2), unique=True)


@query("w4_scd2_keep_history", with_model("SELECT * FROM state", _PATIENTS + _scd2_sql(False)))
def _(t):
    old, now = _patients_before_and_now(t)
    return scd2_merge(old, now, D.PATIENT, "PatientKey", date(2010, 1, 2), reclose=False, unique=True)


_VISIT_GROUPS = "ID, Clinic, Patient, Doctor, Procedure"
_MERGE_SQL = f"""
  src AS (SELECT {_VISIT_GROUPS}, sum(Charge) AS Charge FROM visits WHERE Clinic <> 700 GROUP BY ALL),
  old AS (SELECT {_VISIT_GROUPS}, sum(CASE WHEN Clinic = 200 THEN Charge + 1 ELSE Charge END) AS Charge
    FROM visits WHERE Clinic <> 300 GROUP BY ALL),
  hit AS (SELECT o.* FROM old o JOIN src s ON o.ID = s.ID AND o.Clinic = s.Clinic AND o.Patient = s.Patient
    AND o.Doctor = s.Doctor AND o.Procedure = s.Procedure AND o.Charge = s.Charge),
  ins AS (SELECT * FROM src EXCEPT SELECT * FROM hit),
  del AS (SELECT * FROM old EXCEPT SELECT * FROM hit)
"""


def _visit_merge(t):
    """One clinic's visits are new, one clinic's are gone, one clinic's charge changed.

    Visits without a doctor match nothing.
    """
    groups = [x.strip() for x in _VISIT_GROUPS.split(",")]

    def summed(rows, charge):
        return rows.groupBy(*groups).agg(F.sum(charge).cast("decimal(29,4)").alias("Charge"))

    visits, clinic = M.visits(t), c("Clinic")
    src = summed(visits.where(clinic != 700), c("Charge"))
    raised = F.when(clinic == 200, c("Charge") + 1).otherwise(c("Charge"))
    old = summed(visits.where(clinic != 300), raised)
    return fact_merge(old, src, [*groups, "Charge"], unique=True)


@query(
    "w5_fact_merge",
    with_model(
        "SELECT * REPLACE (CAST(Charge AS DOUBLE) AS Charge) FROM "
        "(SELECT * FROM hit UNION ALL SELECT * FROM ins)",
        _MERGE_SQL,
    ),
)
def _(t):
    return _visit_merge(t).state


@query(
    "w5_fact_merge_deltas",
    with_model(
        "SELECT part, Clinic, count(*) AS n, CAST(sum(Charge) AS DOUBLE) AS charge FROM "
        "(SELECT 'inserted' AS part, * FROM ins UNION ALL SELECT 'deleted', * FROM del) GROUP BY ALL",
        _MERGE_SQL,
    ),
)
def _(t):
    merge = _visit_merge(t)
    both = merge.inserted.select(F.lit("inserted").alias("part"), "*").unionByName(
        merge.deleted.select(F.lit("deleted").alias("part"), "*")
    )
    return both.groupBy("part", "Clinic").agg(
        F.count("*").alias("n"), F.sum("Charge").alias("charge")
    )


# --- transforms --------------------------------------------------------------------------------


@query(
    "w6_dim_dates",
    "SELECT row_number() OVER (ORDER BY d) AS DateKey, CAST(d AS VARCHAR) AS FullDate, "
    "strftime(d, '%A, %m-%d-%Y') AS FullDateName, CAST(strftime(d, '%Y%m') AS BIGINT) AS MonthID, "
    "strftime(d, '%B %Y') AS MonthName, year(d) AS YearID, strftime(d, '%Y') AS YearName, count(o_orderkey) AS n_orders "
    "FROM (SELECT CAST(day AS DATE) AS d FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-31', "
    "INTERVAL 1 DAY) AS g(day)) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d",
)
def _(t):
    """Every day of the calendar with its key, and the orders that fall on it."""
    dates = D.dim_dates(t.spark, date(1996, 1, 1), date(2000, 12, 31))
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("FullDate")).agg(F.count("*").alias("n_orders"))
    return dates.join(per_day, "FullDate", "left").select(*dates.columns, F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query("w7_clinics", with_model("SELECT * FROM clinics_src"))
def _(t):
    return D.dim_clinics_src(M.clinics(t))


@query("w8_doctors", with_model("SELECT * FROM doctors_src"))
def _(t):
    return D.dim_doctors_src(M.doctors(t))


@query(
    "w8_doctors_clean",
    with_model(
        "SELECT * REPLACE (ltrim(DoctorCity) AS DoctorCity, "
        "replace(replace(DoctorState, ' ', ''), 'Redmond', '') AS DoctorState) FROM doctors_src"
    ),
)
def _(t):
    return D.dim_doctors_src(M.doctors(t), clean=True)


@query("w9_patients", with_model("SELECT * FROM patients_src"))
def _(t):
    return D.dim_patients_src(M.patients(t))


@query(
    "w10_procedures",
    with_model("SELECT * REPLACE (CAST(ProcedureCharge AS DOUBLE) AS ProcedureCharge) FROM procedures_src"),
)
def _(t):
    return D.dim_procedures_src(M.procedures(t))


@query(
    "w11_shifts",
    "SELECT ShiftID, CASE ShiftStart WHEN '01:00:00' THEN '13:00:00' ELSE ShiftStart END AS ShiftStart, "
    "CASE ShiftEnd WHEN '05:00:00' THEN '17:00:00' WHEN '21:00:00' THEN '21:00:00' "
    "WHEN '09:00:00' THEN '09:00:00' END AS ShiftEnd FROM "
    "(SELECT event_id AS ShiftID, strftime(ts, '%H:00:00') AS ShiftStart, "
    "strftime(ts + INTERVAL 8 HOUR, '%H:00:00') AS ShiftEnd FROM events)",
)
def _(t):
    """Every event as an eight-hour shift from its own hour."""
    later = c("ts") + F.make_dt_interval(hours=F.lit(8))
    return D.dim_shifts_src(
        t.events.select(
            c("event_id").alias("ShiftID"),
            F.date_format("ts", "HH:00:00").alias("ShiftStart"),
            F.date_format(later, "HH:00:00").alias("ShiftEnd"),
        )
    )


@query("w12_fact_shifts", with_model(shift_facts_sql()))
def _(t):
    return shift_facts(t)


@query(
    "w12_fact_shifts_member",
    with_model(shift_facts_sql("LEFT JOIN")),
)
def _(t):
    return shift_facts(t, "member")


_FACT_OUT = "SELECT * REPLACE (CAST(ProcedureVistCharge AS DOUBLE) AS ProcedureVistCharge) FROM "


@query("w13_fact_visits", with_model(_FACT_OUT + "fact_visits"))
def _(t):
    return visit_facts(t)


@query(
    "w13_fact_visits_member",
    with_model(
        _FACT_OUT + "member_facts",
        """member_facts AS (
  SELECT VisitKey, DateKey, ClinicKey, PatientKey, coalesce(DoctorKey, 0) AS DoctorKey, ProcedureKey,
    sum(ProcedureCharge) AS ProcedureVistCharge
  FROM coded_visits JOIN dim_dates USING (FullDate) JOIN dim_clinics USING (ClinicID)
    JOIN dim_procedures USING (ProcedureID) JOIN dim_patients USING (PatientID)
    LEFT JOIN dim_doctors USING (DoctorID)
  GROUP BY ALL)""",
    ),
)
def _(t):
    return visit_facts(t, "member")


@query(
    "w14_unknown_member",
    with_model(
        "SELECT DoctorID + 1 AS DoctorKey, * FROM doctors_src UNION ALL "
        "SELECT 0, 0, 'Unknown', 'Unknown', 'Unknown', 'Unknown', '00000'"
    ),
)
def _(t):
    dim = D.dim_doctors_src(M.doctors(t)).select((c("DoctorID") + 1).alias("DoctorKey"), *D.DOCTOR)
    return D.with_unknown_member(dim, UNKNOWN_DOCTOR, WAREHOUSE["dim_doctors"])


@query(
    "w15_email_check",
    with_model(
        "SELECT ID, Email, length(Email) AS n FROM (SELECT ID, CASE WHEN instr(Email, '@') = 0 OR "
        "instr(Email, '.com') = 0 THEN Email || ' (Invalid) ' ELSE Email END AS Email FROM patients)"
    ),
)
def _(t):
    return flag_invalid_email(M.patients(t)).select("ID", "Email", F.length("Email").alias("n"))


_PATIENT_COLS = "FName, LName, Email, Address, City, State, ZipCode"


def patient_feeds(t):
    """Three clinics' new patients by region; Asia is served by two of them."""
    rows = M.patients(t).withColumn("ZipCode", c("ZipCode").cast("string")).drop("ID")
    state = c("State")
    return {
        "Bellevue": rows.where(state.isin("AFRICA", "ASIA")),
        "Kirkland": rows.where(state.isin("ASIA", "AMERICA")),
        "Redmond": rows.where(state.isin("EUROPE", "MIDDLE EAST")),
    }


PATIENTS_ARRIVED = """
  arrived AS (SELECT DISTINCT FName, LName, CASE WHEN instr(Email, '@') = 0 OR instr(Email, '.com') = 0
      THEN Email || ' (Invalid) ' ELSE Email END AS Email, Address, City, State, ZipCode FROM patients)
"""
_MARKED = f"""{PATIENTS_ARRIVED},
  loaded AS (SELECT {_PATIENT_COLS} FROM arrived WHERE City IN ('NATION_1', 'NATION_2', 'NATION_3')
    UNION ALL SELECT FName, LName, Email, 'moved', City, State, ZipCode FROM arrived WHERE City = 'NATION_4')
"""


@query("w16_new_patients", with_model("SELECT * FROM arrived EXCEPT SELECT * FROM loaded", _MARKED))
def _(t):
    """Some towns are loaded, one with other addresses, so its patients are new."""
    known = flag_invalid_email(M.patients(t))
    loaded = known.where(c("City").isin("NATION_1", "NATION_2", "NATION_3")).unionByName(
        known.where(c("City") == "NATION_4").withColumn("Address", F.lit("moved"))
    )
    return new_patients(patient_feeds(t), loaded)


def visit_feeds(t):
    """Orders as three clinics' visit files, in each clinic's own layout."""
    rows = t.orders.select(
        "o_orderstatus",
        F.concat((c("o_custkey") % 9 + 9).cast("string"), F.lit(":30")).alias("Time"),
        c("o_custkey").cast("string").alias("Patient"),
        F.substring("o_orderpriority", 1, 1).alias("Doctor"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("Procedure"),
        F.format_string("%.2f", "o_totalprice").alias("Charge"),
        F.to_date("o_orderdate").alias("FileDay"),
    )

    def clinic(status, number, columns):
        part = rows.where(c("o_orderstatus") == status).withColumn("Clinic", F.lit(number))
        return part.select(*columns, "FileDay")

    return {
        "Bellevue": clinic("F", None, ["Time", "Patient", "Doctor", "Procedure", "Charge"]),
        "Kirkland": clinic("O", "2", ["Time", "Patient", "Clinic", "Doctor", "Procedure", "Charge"]),
        "Redmond": clinic("P", "3", ["Time", "Clinic", "Patient", "Doctor", "Procedure", "Charge"]),
    }


ARRIVED_VISITS = """
  arrived AS (SELECT DISTINCT
      {day} + to_hours(CAST(9 + o_custkey % 9 AS BIGINT)) + INTERVAL 30 MINUTE AS Date,
      CAST(CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 200 ELSE 300 END AS BIGINT) AS Clinic,
      o_custkey AS Patient, CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS Doctor,
      CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS Procedure,
      CAST(o_totalprice AS DECIMAL(19,4)) AS Charge
    FROM orders)
"""
VISITS_OUT = (
    "SELECT strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date, Clinic, Patient, Doctor, Procedure, "
    "CAST(Charge AS DOUBLE) AS Charge"
)


@query(
    "w17_new_visits",
    f"WITH {ARRIVED_VISITS.format(day='o_orderdate')} {VISITS_OUT} FROM "
    "(SELECT * FROM arrived EXCEPT SELECT * FROM arrived WHERE Doctor <= 2)",
)
def _(t):
    """Urgent and high orders are loaded already."""
    feeds = visit_feeds(t)
    loaded = None
    for name, feed in feeds.items():
        part = visit_rows(feed, name, c("FileDay")).where(c("Doctor") <= 2)
        loaded = part if loaded is None else loaded.unionByName(part)
    return new_visits(feeds, loaded)


@query(
    "w18_reconcile",
    "SELECT 'orders' AS table_name, b AS rows_before, a AS rows_added, n AS rows_after, "
    "CAST(a + b = n AS BIGINT) AS balanced FROM (SELECT count(*) FILTER (WHERE o_orderdate < DATE '1999-01-01') AS b, "
    "count(*) FILTER (WHERE o_orderdate >= DATE '1999-01-01') AS a, count(*) AS n FROM orders)",
)
def _(t):
    new_year = F.lit("1999-01-01").cast("timestamp_ntz")
    before = t.orders.where(c("o_orderdate") < new_year)
    added = t.orders.where(c("o_orderdate") >= new_year)
    return reconcile(before, t.orders, added, "orders")


# --- checks ------------------------------------------------------------------------------------


@query(
    "q1_duplicate_keys",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1",
)
def _(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q2_orphans",
    "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)",
)
def _(t):
    return quality.orphans(t.events.select("event_id", "user_id"), "user_id", t.supplier, "s_suppkey")


@query("q3_outside_set", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(t):
    return quality.outside_set(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])


@query(
    "q4_missing",
    with_model(
        "SELECT ID, concat_ws(',', CASE WHEN FName IS NULL THEN 'FName' END, CASE WHEN Email IS NULL THEN 'Email' END, "
        "CASE WHEN ZipCode IS NULL THEN 'ZipCode' END) AS missing FROM patients "
        "WHERE FName IS NULL OR Email IS NULL OR ZipCode IS NULL"
    ),
)
def _(t):
    found = quality.missing(M.patients(t).select("ID", "FName", "Email", "ZipCode"), ["FName", "Email", "ZipCode"])
    return found.select("ID", F.concat_ws(",", "missing").alias("missing"))


@query(
    "q5_too_long",
    with_model(
        "SELECT DoctorID, concat_ws(',', CASE WHEN length(Zip) > 5 THEN 'Zip' END, "
        "CASE WHEN length(State) > 3 THEN 'State' END) AS too_long FROM doctors "
        "WHERE length(Zip) > 5 OR length(State) > 3"
    ),
)
def _(t):
    found = quality.too_long(M.doctors(t).select("DoctorID", "Zip", "State"), {"Zip": 5, "State": 3})
    return found.select("DoctorID", F.concat_ws(",", "too_long").alias("too_long"))


@query(
    "q_row_rules",
    with_model(
        "SELECT DoctorID, 'DoctorState over 3' AS rule FROM doctors_src WHERE length(DoctorState) > 3 UNION ALL "
        "SELECT DoctorID, 'name unchecked' FROM doctors_src WHERE DoctorFullName = 'Check'"
    ),
)
def _(t):
    """Several rules in one scan."""
    rules = {
        "DoctorState over 3": F.length("DoctorState") <= 3,
        "name unchecked": c("DoctorFullName") != "Check",
    }
    return quality.row_violations(D.dim_doctors_src(M.doctors(t)), rules, ["DoctorID"])
