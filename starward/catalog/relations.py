"""Joins, aggregates, sorts and set operations over whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from starward.catalog import model as M
from starward.catalog.model import with_model
from starward.catalog.registry import query
from starward.functions import codes
from starward.operators.keys import assign_keys
from starward.operators.lookup import lookup_key
from starward.operators.merge import fact_merge
from starward.operators.reconcile import row_count
from starward.operators.setops import change_set, except_distinct, union_distinct
from starward.plans import dimensions as D
from starward.plans.facts import fact_shifts_src, fact_visits_src
from starward.plans.readback import charges_by_month, star_readback
from starward.plans.together import results_of

c = F.col


def dim_clinics(t):
    return assign_keys(D.dim_clinics_src(M.clinics(t)), "ClinicKey", ["ClinicID"], unique=True)


def dim_doctors(t):
    return assign_keys(D.dim_doctors_src(M.doctors(t)), "DoctorKey", ["DoctorID"], unique=True)


def dim_patients(t):
    rows = D.dim_patients_src(M.patients(t)).withColumn("IsCurrent", F.lit(1))
    return assign_keys(rows, "PatientKey", ["PatientID"], unique=True)


def dim_procedures(t):
    rows = D.dim_procedures_src(M.procedures(t))
    return assign_keys(rows, "ProcedureKey", ["ProcedureID"], unique=True)


def dim_shifts(t):
    return assign_keys(D.dim_shifts_src(M.shifts(t)), "ShiftKey", ["ShiftID"], unique=True)


def keyed_dims(t):
    """The four dimensions of the visits, numbered side by side."""
    return results_of(
        t.spark,
        {
            "clinics": partial(dim_clinics, t),
            "patients": partial(dim_patients, t),
            "doctors": partial(dim_doctors, t),
            "procedures": partial(dim_procedures, t),
        },
    )


def visit_facts(t, unknown="drop"):
    return fact_visits_src(M.visits(t), M.visit_dates(t), **keyed_dims(t), unknown=unknown)


def shift_facts(t, unknown="drop"):
    dims = results_of(
        t.spark,
        {
            "clinics": partial(dim_clinics, t),
            "shifts": partial(dim_shifts, t),
            "doctors": partial(dim_doctors, t),
        },
    )
    return fact_shifts_src(M.doctor_shifts(t), M.shift_dates(t), **dims, unknown=unknown)


# --- joins -------------------------------------------------------------------------------------


@query(
    "j1_natural_to_surrogate",
    with_model("SELECT DoctorsShiftID, DoctorKey FROM doctor_shifts s JOIN dim_doctors d ON s.DoctorID = d.DoctorID"),
)
def _(t):
    rows = M.doctor_shifts(t).select("DoctorsShiftID", "DoctorID")
    return lookup_key(rows, dim_doctors(t), c("DoctorID"), "DoctorID", ["DoctorKey"]).drop("DoctorID")


@query(
    "j2_join_on_date_cast",
    with_model("SELECT ID, DateKey FROM visits v JOIN dim_dates d ON CAST(v.Date AS DATE) = d.FullDate"),
)
def _(t):
    rows = M.visits(t).select("ID", "Date")
    return lookup_key(rows, M.visit_dates(t), F.to_date("Date"), "FullDate", ["DateKey"]).drop("Date")


@query(
    "j3_join_on_code",
    with_model(
        "SELECT ID, Clinic, ClinicKey FROM visits JOIN dim_clinics ON Clinic = 100 * ClinicID "
        "WHERE ClinicID <= 3"
    ),
)
def _(t):
    rows = M.visits(t).select("ID", "Clinic")
    return lookup_key(rows, dim_clinics(t), codes.clinic_id(c("Clinic")), "ClinicID", ["ClinicKey"])


def shift_facts_sql(doctor_join: str = "JOIN") -> str:
    return f"""
  SELECT DoctorsShiftID, date_diff('day', DATE '2024-01-01', ShiftDate) + 1 AS ShiftDateKey, ClinicKey,
    ShiftKey, coalesce(DoctorKey, 0) AS DoctorKey, ShiftStart, ShiftEnd,
    abs(CAST(ShiftEnd[1:2] AS BIGINT) - CAST(ShiftStart[1:2] AS BIGINT)) AS HoursWorked
  FROM doctor_shifts JOIN dim_clinics USING (ClinicID) JOIN dim_shifts USING (ShiftID)
    {doctor_join} dim_doctors USING (DoctorID)
  WHERE year(ShiftDate) = 2024"""


@query("j4_four_way_lookup", with_model(shift_facts_sql()))
def _(t):
    return shift_facts(t)


@query(
    "j5_five_way_lookup",
    with_model("SELECT VisitKey, DateKey, ClinicKey, PatientKey, DoctorKey, ProcedureKey FROM fact_visits"),
)
def _(t):
    return visit_facts(t).drop("ProcedureVistCharge")


@query(
    "j6_unknown_member",
    with_model(
        "SELECT DoctorsShiftID, coalesce(DoctorKey, 0) AS DoctorKey "
        "FROM (SELECT DoctorsShiftID, CASE WHEN ClinicID <> 9 THEN DoctorID END AS DoctorID FROM doctor_shifts) s "
        "LEFT JOIN dim_doctors d ON s.DoctorID = d.DoctorID"
    ),
)
def _(t):
    """Shifts at no known clinic lose their doctor; others have doctors that do not exist."""
    doctor = F.when(c("ClinicID") != 9, c("DoctorID")).alias("DoctorID")
    rows = M.doctor_shifts(t).select("DoctorsShiftID", doctor)
    return lookup_key(rows, dim_doctors(t), c("DoctorID"), "DoctorID", ["DoctorKey"], "member").drop(
        "DoctorID"
    )


@query(
    "j7_semi_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN "
    "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)",
)
def _(t):
    returned = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(
        c("l_orderkey").alias("o_orderkey")
    )
    return t.orders.select("o_orderkey", "o_custkey").join(returned, "o_orderkey", "left_semi")


@query(
    "j8_anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN "
    "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)",
)
def _(t):
    returned = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(
        c("l_orderkey").alias("o_orderkey")
    )
    return t.orders.select("o_orderkey", "o_custkey").join(returned, "o_orderkey", "left_anti")


# Yesterday's shift facts lack the sign-ups, still hold the errors, and had no hours for clicks.
_MATCH_SQL = """
  src AS (SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(hour(ts) AS BIGINT) END AS hours
    FROM events WHERE event_type <> 'error'),
  tgt AS (SELECT event_id, user_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE CAST(hour(ts) AS BIGINT) END AS hours
    FROM events WHERE event_type <> 'signup'),
  pairs AS (SELECT t.event_id FROM tgt t JOIN src s
    ON t.event_id = s.event_id AND t.user_id = s.user_id AND t.hours = s.hours)
"""


def _match(t):
    kind, hour = c("event_type"), F.hour("ts")
    src = t.events.where(kind != "error").select(
        "event_id", "user_id", F.when(kind != "view", hour).alias("hours")
    )
    tgt = t.events.where(kind != "signup").select(
        "event_id", "user_id", F.when(~kind.isin("view", "click"), hour).alias("hours")
    )
    return fact_merge(tgt, src, ["event_id", "user_id", "hours"])


@query(
    "j9_merge_match",
    f"WITH {_MATCH_SQL} "
    "SELECT 'inserted' AS part, * FROM src WHERE event_id NOT IN (SELECT event_id FROM pairs) "
    "UNION ALL SELECT 'deleted', * FROM tgt WHERE event_id NOT IN (SELECT event_id FROM pairs)",
)
def _(t):
    merge = _match(t)
    return merge.inserted.select(F.lit("inserted").alias("part"), "*").unionByName(
        merge.deleted.select(F.lit("deleted").alias("part"), "*")
    )


STAR_SQL = """
  SELECT * FROM fact_visits JOIN dim_dates USING (DateKey) JOIN dim_clinics USING (ClinicKey)
    JOIN dim_procedures USING (ProcedureKey) JOIN dim_doctors USING (DoctorKey)
    JOIN dim_patients USING (PatientKey)
"""


def star(t):
    dims, dates = keyed_dims(t), M.visit_dates(t)
    facts = fact_visits_src(M.visits(t), dates, **dims)
    return star_readback(facts, dates=dates, **dims)


@query(
    "j10_star_readback",
    with_model(
        "SELECT VisitKey, DateKey, ClinicKey, PatientKey, DoctorKey, ProcedureKey, FullDateName, ClinicName, "
        "DoctorFullName, PatientFullName, PatientState, ProcedureName, "
        "CAST(ProcedureVistCharge AS DOUBLE) AS ProcedureVistCharge FROM star",
        f"star AS ({STAR_SQL})",
    ),
)
def _(t):
    return star(t).select(
        "VisitKey",
        "DateKey",
        "ClinicKey",
        "PatientKey",
        "DoctorKey",
        "ProcedureKey",
        "FullDateName",
        "ClinicName",
        "DoctorFullName",
        "PatientFullName",
        "PatientState",
        "ProcedureName",
        "ProcedureVistCharge",
    )


@query(
    "j10_charges_by_month",
    with_model(
        "SELECT MonthID, MonthName, ClinicName, count(*) AS visits, "
        "CAST(sum(ProcedureVistCharge) AS DOUBLE) AS charge FROM star GROUP BY ALL",
        f"star AS ({STAR_SQL})",
    ),
)
def charges(t):
    """The flagship: the whole star, summed by month and clinic."""
    return charges_by_month(star(t))


# --- aggregates, sorts -------------------------------------------------------------------------


@query(
    "a1_sum_by_keys",
    "SELECT l_orderkey, l_partkey, l_suppkey, "
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DOUBLE) AS charge FROM lineitem GROUP BY ALL",
)
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
        F.sum(c("l_extendedprice").cast("decimal(19,4)")).alias("charge")
    )


@query(
    "a2_row_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}"
        for n in ("orders", "lineitem", "customer", "part", "supplier", "events")
    ),
)
def _(t):
    first, *rest = [
        row_count(getattr(t, n), n)
        for n in ("orders", "lineitem", "customer", "part", "supplier", "events")
    ]
    for part in rest:
        first = first.unionByName(part)
    return first


@query("a3_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query(
    "o1_sort",
    "SELECT strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS o_orderdate, o_custkey, o_orderkey FROM orders "
    "ORDER BY o_orderdate, o_custkey, o_orderkey",
)
def _(t):
    return t.orders.select("o_orderdate", "o_custkey", "o_orderkey").orderBy(
        "o_orderdate", "o_custkey", "o_orderkey"
    )


@query(
    "o2_keys_by_order",
    "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VisitKey, o_orderkey FROM orders",
)
def _(t):
    rows = t.orders.select("o_orderdate", "o_orderkey")
    return assign_keys(rows, "VisitKey", ["o_orderdate", "o_orderkey"], unique=True).drop("o_orderdate")


@query(
    "o3_top_two",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2",
)
def _(t):
    """The limit is the feature; each task keeps its own two."""
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(c("o_totalprice").desc(), "o_orderkey")
        .limit(2)
    )


# --- set operations ----------------------------------------------------------------------------

_PARTS = "SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = "


@query("u1_union", f"{_PARTS}'F' UNION {_PARTS}'O' UNION {_PARTS}'P'")
def _(t):
    return union_distinct(*_status_parts(t))


def _status_parts(t):
    return [
        t.orders.where(c("o_orderstatus") == s).select("o_custkey", "o_orderpriority") for s in "FOP"
    ]


@query(
    "u2_except",
    "SELECT c_mktsegment, CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS BIGINT) AS nation FROM customer "
    "EXCEPT SELECT c_mktsegment, CASE WHEN c_acctbal >= 9000 THEN c_nationkey END FROM customer "
    "WHERE c_acctbal >= 8900",
)
def _(t):
    """NULL equals NULL on both sides."""
    bal = c("c_acctbal")
    left = t.customer.select("c_mktsegment", F.when(bal >= 0, c("c_nationkey")).alias("nation"))
    right = t.customer.where(bal >= 8900).select(
        "c_mktsegment", F.when(bal >= 9000, c("c_nationkey")).alias("nation")
    )
    return except_distinct(left, right)


@query(
    "u3_union_except",
    f"{_PARTS}'F' UNION {_PARTS}'O' UNION {_PARTS}'P' "
    "EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_totalprice > 400000",
)
def _(t):
    loaded = t.orders.where("o_totalprice > 400000").select("o_custkey", "o_orderpriority")
    return except_distinct(union_distinct(*_status_parts(t)), loaded)


_SIDES = (
    "src AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS seg "
    "FROM customer WHERE c_acctbal >= 0), "
    "tgt AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL "
    "ELSE c_mktsegment END AS seg FROM customer WHERE c_acctbal < 9000)"
)


@query(
    "u4_change_set",
    f"WITH {_SIDES} SELECT *, CAST(1 AS BIGINT) AS in_source, CAST(0 AS BIGINT) AS in_target FROM "
    "(SELECT * FROM src EXCEPT SELECT * FROM tgt) UNION ALL "
    "SELECT *, 0, 1 FROM (SELECT * FROM tgt EXCEPT SELECT * FROM src)",
)
def _(t):
    seg = c("c_mktsegment")
    src = t.customer.where("c_acctbal >= 0").select(
        "c_custkey", "c_name", F.when(seg != "BUILDING", seg).alias("seg")
    )
    tgt = t.customer.where("c_acctbal < 9000").select(
        "c_custkey", "c_name", F.when(~seg.isin("BUILDING", "FURNITURE"), seg).alias("seg")
    )
    return change_set(src, tgt, ["c_custkey", "c_name", "seg"])
