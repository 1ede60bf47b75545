"""What a run writes, checks and counts: commits by part, growing history, references, ledgers, repeated runs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.catalog import model as M
from starward.catalog.files import DAY, warehouse_sources, write_feeds
from starward.catalog.loads import doctors_before_and_now, patient_feeds, visit_feeds
from starward.catalog.model import with_model
from starward.catalog.registry import query
from starward.operators.history import scd2_merge
from starward.operators.lookup import lookup_key
from starward.operators.quality import reference_violations
from starward.operators.remap import key_changes, remapped
from starward.operators.sync import scd1_sync
from starward.plans import dimensions as D
from starward.plans.file_load import Operational, load_daily_files
from starward.plans.warehouse_load import Warehouse, load_warehouse, merge_facts, stage_sources
from starward.schemas import WAREHOUSE
from starward.session import hashed_joins
from starward.sources.generated import date_spine
from starward.sources.history import HistoryTable
from starward.sources.parts import PartTable
from starward.sources.scratch import scratch_path, staged

c = F.col
YEAR = T.StructField("year", T.IntegerType())
_ORDERS = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("price", T.DoubleType())]
)


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderstatus", c("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))


# --- commits -----------------------------------------------------------------------------------


@query(
    "s7_commit_parts",
    "SELECT o_orderkey, o_totalprice + CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END AS price, "
    "CASE WHEN year(o_orderdate) = 1997 THEN 2 ELSE 1 END AS written FROM orders",
)
def _(t):
    """One year's rows change; the other years' folders are those of the first commit."""
    table = PartTable(t.spark, scratch_path(t.spark, "parts"), _ORDERS, YEAR)
    table.commit(_orders(t))
    changed = table.read([1997], stored=True).withColumn("price", c("price") + 1)
    table.commit(changed, replace=[1997])
    written = F.regexp_extract("_metadata.file_path", r"version=(\d+)", 1).cast("int")
    folders = [f"{table.root}/data/{p.folder}" for p in table.parts()]
    rows = t.spark.read.schema(_ORDERS).parquet(*folders)
    return rows.select("o_orderkey", "price", written.alias("written"))


@query("s5_atomic_append", "SELECT o_orderkey, o_orderstatus, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'O'")
def _(t):
    """Three appends by year, the second of which fails in the middle: nobody sees any of its rows."""
    table = PartTable(t.spark, scratch_path(t.spark, "append"), _ORDERS, YEAR)
    rows, status = _orders(t), c("o_orderstatus")
    table.commit(rows.where(status == "F"), replace=())
    lost = F.when(c("o_orderkey") % 5 == 0, F.raise_error(F.lit("lost"))).otherwise(status)
    try:
        table.commit(rows.where(status == "O").withColumn("o_orderstatus", lost), replace=())
    except Exception as failure:
        if "lost" not in str(failure):
            raise
    table.commit(rows.where((status != "F") & (status != "O")), replace=())
    return table.read()


_GROUPS = ["ID", "Clinic", "Patient", "Doctor", "Procedure"]
_MONTHLY = T.StructType([*[T.StructField(x, T.LongType()) for x in _GROUPS], T.StructField("Charge", T.DecimalType(29, 4))])


@query(
    "w5_by_digest",
    with_model(
        "SELECT CAST(strftime(Date, '%Y%m') AS BIGINT) AS MonthID, ID, Clinic, Patient, Doctor, Procedure, "
        "CAST(sum(Charge) AS DOUBLE) AS Charge, CAST(year(Date) = 1997 AS BIGINT) AS written_again FROM visits GROUP BY 1, 2, 3, 4, 5, 6, 8"
    ),
)
def _(t):
    """A fact by months, merged twice; only one year's charges differ, and only its months are written again."""
    month = F.date_format("Date", "yyyyMM").cast("int").alias("MonthID")
    visits = M.visits(t).withColumn("year", F.year("Date"))

    def summed(charge):
        return visits.groupBy(*_GROUPS, month).agg(F.sum(charge).cast("decimal(29,4)").alias("Charge"))

    table = PartTable(t.spark, scratch_path(t.spark, "fact"), _MONTHLY, T.StructField("MonthID", T.IntegerType()))
    raised = F.when(c("year") == 1997, c("Charge") + 1).otherwise(c("Charge"))
    merge_facts(table, summed(raised), _MONTHLY.names, unique=True)
    merge_facts(table, summed(c("Charge")), _MONTHLY.names, unique=True)
    rewritten = [int(p.part) for p in table.parts() if p.folder.startswith("version=00000002")]
    return table.read(stored=True).withColumn("written_again", c("MonthID").isin(rewritten))


# --- history -----------------------------------------------------------------------------------

_RUNS = """
  first AS (SELECT PatientID, PatientFullName, CASE WHEN PatientState = 'EUROPE' THEN 'Old Town' ELSE PatientCity END AS PatientCity,
      PatientState, PatientZipCode FROM patients_src WHERE PatientState <> 'ASIA'),
  kept AS (SELECT row_number() OVER (ORDER BY PatientID) AS PatientKey, * FROM first),
  opened AS (SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY PatientID) AS PatientKey, *
    FROM patients_src WHERE PatientState IN ('ASIA', 'EUROPE'))
"""


@query(
    "w4_growing_history",
    with_model(
        "SELECT *, '2010-01-02' AS StartDate, CASE WHEN PatientState IN ('AFRICA', 'EUROPE') THEN '2010-01-04' END AS EndDate, "
        "CAST(PatientState NOT IN ('AFRICA', 'EUROPE') AS BIGINT) AS IsCurrent FROM kept "
        "UNION ALL SELECT *, '2010-01-03', NULL, 1 FROM opened",
        _RUNS,
    ),
)
def _(t):
    """Three runs: a first fill, a day on which some move, come or go, and one that only closes again what is closed."""
    now, state = D.dim_patients_src(M.patients(t)), c("PatientState")
    table = HistoryTable(t.spark, scratch_path(t.spark, "history"), WAREHOUSE["dim_patients"], "PatientKey")
    city = F.when(state == "EUROPE", "Old Town").otherwise(c("PatientCity"))
    table.merge(now.where(state != "ASIA").withColumn("PatientCity", city), D.PATIENT, DAY, unique=True)
    later = now.where(state != "AFRICA")
    table.merge(later, D.PATIENT, date(2010, 1, 3), unique=True)
    table.merge(later, D.PATIENT, date(2010, 1, 4), unique=True)
    return table.read()


# --- keys and references -----------------------------------------------------------------------


@query(
    "w2_key_remap",
    with_model(
        "SELECT ID, Date, Doctor AS DoctorID, CAST(count(*) AS BIGINT) AS n FROM "
        "(SELECT ID, strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date, Doctor FROM visits JOIN doctors_src ON Doctor = DoctorID "
        "WHERE DoctorCity NOT IN ('  NATION_3', '  NATION_7')) GROUP BY ALL"
    ),
)
def _(t):
    """Visits keyed before a sync that gave some doctors new keys, carried over and read back by the keys after it."""
    old, now = doctors_before_and_now(t)
    after = scd1_sync(old, now, "DoctorID", D.DOCTOR, "DoctorKey", on_delete="drop", unique=True)
    keyed = M.visits(t).join(old.select("DoctorID", "DoctorKey"), c("Doctor") == c("DoctorID")).select("ID", "Date", "DoctorKey")
    moved = remapped(keyed, "DoctorKey", key_changes(old, after, "DoctorID", "DoctorKey"))
    read_back = moved.join(after.select("DoctorKey", "DoctorID"), "DoctorKey")
    return read_back.groupBy("ID", "Date", "DoctorID").agg(F.count("*").alias("n"))


#: How the clinics' database server compares texts: without case and without blanks at the end.
_SERVER = "UTF8_LCASE_RTRIM"


@query(
    "w2_collated",
    with_model(
        "SELECT * FROM old WHERE DoctorCity <> '  NATION_9' UNION ALL SELECT (SELECT max(DoctorKey) FROM old) + row_number() OVER (ORDER BY DoctorID), "
        "* FROM doctors_src WHERE DoctorCity = '  NATION_9'",
        """
  old AS (SELECT DoctorID + 1 AS DoctorKey, DoctorID, CASE WHEN DoctorCity = '  NATION_5' THEN upper(DoctorFullName) || '  ' ELSE DoctorFullName END
      AS DoctorFullName, DoctorEmailAddress, DoctorCity, CASE WHEN DoctorCity = '  NATION_9' THEN 'OR' ELSE DoctorState END AS DoctorState, DoctorZip
    FROM doctors_src)""",
    ),
)
def _(t):
    """Names that differ in case and end blanks only are no change; the doctors of one town changed their state."""
    now, city = D.dim_doctors_src(M.doctors(t)), c("DoctorCity")
    name = F.when(city == "  NATION_5", F.concat(F.upper("DoctorFullName"), F.lit("  "))).otherwise(c("DoctorFullName"))
    state = F.when(city == "  NATION_9", "OR").otherwise(c("DoctorState"))
    old = now.withColumns({"DoctorKey": c("DoctorID") + 1, "DoctorFullName": name, "DoctorState": state})
    return scd1_sync(
        old.select("DoctorKey", *D.DOCTOR), now, "DoctorID", D.DOCTOR, "DoctorKey", name_column="DoctorFullName", unique=True, collation=_SERVER
    )


@query(
    "w4_collated",
    with_model(
        "SELECT PatientID + 1 AS PatientKey, PatientID, PatientFullName, upper(PatientCity) || ' ' AS PatientCity, PatientState, PatientZipCode, "
        "'2009-07-01' AS StartDate, CASE WHEN PatientState = 'ASIA' THEN '2010-01-02' END AS EndDate, CAST(PatientState <> 'ASIA' AS BIGINT) AS IsCurrent "
        "FROM patients_src UNION ALL SELECT (SELECT max(PatientID) + 1 FROM patients_src) + row_number() OVER (ORDER BY PatientID), PatientID, PatientFullName, "
        "'new ' || PatientCity, PatientState, PatientZipCode, '2010-01-02', NULL, 1 FROM patients_src WHERE PatientState = 'ASIA'"
    ),
)
def _(t):
    """Cities told in capitals with a blank behind are the same cities; one state's patients did move."""
    now, city = D.dim_patients_src(M.patients(t)), c("PatientCity")
    old = now.select(
        (c("PatientID") + 1).alias("PatientKey"), "PatientID", "PatientFullName", F.concat(F.upper(city), F.lit(" ")).alias("PatientCity"),
        "PatientState", "PatientZipCode", F.lit("2009-07-01").cast("date").alias("StartDate"), F.lit(None).cast("date").alias("EndDate"), F.lit(1).alias("IsCurrent"),
    )
    moved = now.withColumn("PatientCity", F.when(c("PatientState") == "ASIA", F.concat(F.lit("new "), city)).otherwise(city))
    return scd2_merge(old, moved, D.PATIENT, "PatientKey", DAY, unique=True, collation=_SERVER)


@query(
    "j1_collated",
    "SELECT c_custkey, n_nationkey AS NationKey FROM customer JOIN nation ON lower(rtrim(CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) || '  ' ELSE upper(n_name) END)) "
    "= lower(rtrim(n_name)) WHERE c_nationkey = n_nationkey AND c_custkey % 7 <> 0 UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_custkey % 7 = 0",
)
def _(t):
    """Nations looked up by names written in another case, with blanks behind or with one in front, which counts."""
    named = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select("c_custkey", "n_name")
    odd = F.when(c("c_custkey") % 7 == 0, F.concat(F.lit(" "), "n_name")).when(c("c_custkey") % 2 == 0, F.concat(F.lower("n_name"), F.lit("  "))).otherwise(F.upper("n_name"))
    dim = t.nation.select("n_name", c("n_nationkey").alias("NationKey"))
    rows = named.select("c_custkey", odd.alias("written"))
    return lookup_key(rows, dim, c("written"), "n_name", ["NationKey"], unknown="member", collation=_SERVER).select("c_custkey", "NationKey")


def _loaded(t, runs, **how) -> Warehouse:
    """A warehouse after ``runs``, each the sources of a day."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    for i, sources in enumerate(runs):
        staged = stage_sources(t.spark, sources, f"{warehouse.root}/run{i}")
        day = date(DAY.year, DAY.month, DAY.day + i)
        load_warehouse(
            warehouse, staged, day, datetime(day.year, day.month, day.day, 1), days=M.ALL_DAYS, spine=date_spine(t.spark, *M.ALL_DAYS), **how
        )
    return warehouse


_SHIFT_FACTS = (
    "shift_facts AS (SELECT * FROM doctor_shifts JOIN dim_clinics USING (ClinicID) JOIN dim_shifts USING (ShiftID) "
    "JOIN dim_doctors USING (DoctorID))"
)


@query(
    "x2_orphans",
    with_model(
        "SELECT 'fact_visits' AS \"table\", 'DoctorKey not in dim_doctors' AS rule, count(*) AS rows FROM fact_visits WHERE DoctorKey % 3 = 0 "
        "HAVING count(*) > 0 UNION ALL SELECT 'fact_doctor_shifts', 'DoctorKey not in dim_doctors', count(*) FROM shift_facts WHERE DoctorKey % 3 = 0 "
        "HAVING count(*) > 0",
        _SHIFT_FACTS,
    ),
)
def _(t):
    """A loaded warehouse from whose doctors a third is then taken: the facts that refer to them."""
    w = _loaded(t, [warehouse_sources(t)])
    w.table("dim_doctors").commit(w.read("dim_doctors").where("DoctorKey % 3 <> 0 OR DoctorKey = 0"))
    dims = {name: w.read(name) for name in WAREHOUSE if name.startswith("dim_")}
    found = [reference_violations(name, w.read(name), dims) for name in ("fact_visits", "fact_doctor_shifts")]
    return found[0].unionByName(found[1])


# --- repeated runs and what they count ---------------------------------------------------------


@query(
    "x2_second_run",
    with_model(
        "SELECT VisitKey, MonthID, DoctorID, DoctorFullName, DoctorState, PatientID, PatientCity, ClinicID, ProcedureID, "
        "CAST(ProcedureVistCharge AS DOUBLE) AS ProcedureVistCharge FROM fact_visits JOIN dim_dates USING (DateKey) JOIN dim_doctors USING (DoctorKey) "
        "JOIN dim_patients USING (PatientKey) JOIN dim_clinics USING (ClinicKey) JOIN dim_procedures USING (ProcedureKey)"
    ),
)
def _(t):
    """Three runs in which doctors change, go and come back and patients move: the facts read back by the keys that live."""
    base = warehouse_sources(t)
    # The runs read one table of visits, as they would where it isn't a join of others.  No run reads a visit's own charge.
    with hashed_joins(t.spark):
        base["visits"] = staged(base["visits"].drop("Charge"), "visits")
    city, state = c("City"), c("State")
    moved = base["patients"].withColumn("City", F.when(state == "EUROPE", "Old Town").otherwise(city))
    first = base["doctors"].where(city != "  NATION_3").withColumn("State", F.when(city == "  NATION_5", "OR").otherwise(state))
    runs = [base | {"doctors": first, "patients": moved}, base | {"doctors": base["doctors"].where(city != "  NATION_7")}, base]
    w = _loaded(t, runs)
    rows = w.read("fact_visits")
    for dim, key in (("dim_dates", "DateKey"), ("dim_doctors", "DoctorKey"), ("dim_clinics", "ClinicKey"), ("dim_procedures", "ProcedureKey")):
        rows = rows.join(w.read(dim), key)
    rows = rows.join(w.table("dim_patients").current(), "PatientKey")
    return rows.select("VisitKey", "MonthID", "DoctorID", "DoctorFullName", "DoctorState", "PatientID", "PatientCity", "ClinicID", "ProcedureID", "ProcedureVistCharge")


@query(
    "x2_reconcile",
    with_model(
        "SELECT 'fact_visits' AS table_name, part, n_rows FROM ("
        "SELECT 'before' AS part, 0 AS n_rows UNION ALL SELECT 'gone', 0 "
        "UNION ALL SELECT 'added', count(*) FROM fact_visits UNION ALL SELECT 'after', count(*) FROM fact_visits "
        "UNION ALL SELECT 'read', count(*) FROM visits UNION ALL SELECT 'dropped by dim_dates', 0 "
        "UNION ALL SELECT 'dropped by dim_clinics', count(*) FROM visits WHERE Clinic NOT IN (100, 200, 300) "
        "UNION ALL SELECT 'dropped by dim_procedures', count(*) FROM coded_visits WHERE ProcedureID NOT IN (SELECT ProcedureID FROM procedures_src) "
        "UNION ALL SELECT 'dropped by dim_doctors', count(*) FROM coded_visits WHERE DoctorID IS NULL OR DoctorID NOT IN (SELECT DoctorID FROM doctors_src) "
        "UNION ALL SELECT 'dropped by dim_patients', count(*) FROM coded_visits WHERE DoctorID IN (SELECT DoctorID FROM doctors_src) "
        "AND PatientID NOT IN (SELECT PatientID FROM patients_src))"
    ),
)
def _(t):
    """What a run says of the visit fact: rows before, added, gone and after, rows read, and those that each lookup dropped."""
    counts = _loaded(t, [warehouse_sources(t)]).counts()
    return counts.where("table_name = 'fact_visits'").select("table_name", "part", "n_rows")


@query(
    "s1_redelivered_files",
    "WITH sent AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'Bellevue' WHEN 'O' THEN 'Kirkland' ELSE 'Redmond' END AS Clinic, "
    "o_orderdate >= DATE '1998-01-01' AS late FROM orders) "
    "SELECT Clinic, 'Visits' AS Kind, '20100102Visits.csv' AS File, 'new' AS State, count(*) FILTER (WHERE NOT late) AS Lines FROM sent GROUP BY Clinic "
    "UNION ALL SELECT Clinic, 'Visits', '20100102Visits.csv', 'changed', count(*) FILTER (WHERE late) FROM sent WHERE Clinic = 'Redmond' GROUP BY Clinic",
)
def _(t):
    """A day's files loaded, one clinic's then delivered again with other visits: each content a file came with."""
    spark = t.spark
    into = Operational(scratch_path(spark, "operational"))
    early = c("FileDay") < F.lit("1998-01-01").cast("date")
    for clinics in (("Bellevue", "Kirkland", "Redmond"), ("Redmond",)):
        folder = scratch_path(spark, "feeds")
        write_feeds(patient_feeds(t), folder, "NewPatients", DAY)
        first = {clinic: feed.where(early) for clinic, feed in visit_feeds(t).items()}
        again = {clinic: feed.where(~early) for clinic, feed in visit_feeds(t).items() if len(clinics) == 1 and clinic in clinics}
        write_feeds(first | again, folder, "Visits", DAY)
        load_daily_files(spark, folder, into, DAY)
    return into.files(spark).where("Kind = 'Visits'").select("Clinic", "Kind", "File", "State", "Lines")


# --- every table of the job --------------------------------------------------------------------

_JOB_TABLES = {
    "x2_clinics": ("dim_clinics", "SELECT * FROM dim_clinics"),
    "x2_patients": ("dim_patients", "SELECT *, '2010-01-02' AS StartDate, CAST(NULL AS VARCHAR) AS EndDate FROM dim_patients"),
    "x2_procedures": ("dim_procedures", "SELECT * REPLACE (CAST(ProcedureCharge AS DOUBLE) AS ProcedureCharge) FROM dim_procedures"),
    "x2_shifts": ("dim_shifts", "SELECT * FROM dim_shifts"),
    "x2_dates": (
        "dim_dates",
        "SELECT row_number() OVER (ORDER BY d) AS DateKey, CAST(d AS VARCHAR) AS FullDate, strftime(d, '%A, %m-%d-%Y') AS FullDateName, "
        "CAST(strftime(d, '%Y%m') AS BIGINT) AS MonthID, strftime(d, '%B %Y') AS MonthName, year(d) AS YearID, strftime(d, '%Y') AS YearName "
        "FROM (SELECT CAST(day AS DATE) AS d FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY) AS g(day))",
    ),
}


def _job_table(name: str, table: str, sql: str) -> None:
    def run(t):
        return _loaded(t, [warehouse_sources(t)]).read(table)

    run.__doc__ = f"{table} after the whole load."
    query(name, with_model(sql))(run)


for _name, (_table, _sql) in _JOB_TABLES.items():
    _job_table(_name, _table, _sql)
