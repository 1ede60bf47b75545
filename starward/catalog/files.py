"""Sources, sinks and whole jobs; each query writes what it reads below the scratch folder."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from starward.catalog import model as M
from starward.catalog.loads import ARRIVED_VISITS, PATIENTS_ARRIVED, VISITS_OUT, patient_feeds, visit_feeds
from starward.catalog.model import with_model
from starward.catalog.registry import query
from starward.operators.reconcile import reconcile
from starward.plans import dimensions as D
from starward.plans.file_load import Operational, load_daily_files
from starward.plans.warehouse_load import Warehouse, load_warehouse, stage_sources
from starward.schemas import CLINICS, FEED_SCHEMAS, UNKNOWN_DOCTOR, WAREHOUSE
from starward.sources.feeds import read_feed, read_feed_by_header, read_feeds, rejected_lines
from starward.sources.generated import date_spine, literal_rows
from starward.sources.runlog import log_event, log_view
from starward.sources.scratch import scratch_path
from starward.sources.snapshots import SnapshotTable, commit_snapshot
from starward.sources.tables import (
    append_rows,
    full_refresh,
    read_table,
    read_table_or_empty,
    stage_table,
)
from starward.streaming.daily_files import load_new_files

c = F.col
DAY = date(2010, 1, 2)


def write_feeds(feeds, folder: str, kind: str, day: date) -> None:
    """Write feeds the way the clinics deliver them: one named, headed CSV per clinic and kind."""
    for clinic, feed in feeds.items():
        columns = FEED_SCHEMAS[(clinic, kind)].names
        target = f"{folder}/{clinic}/{day:%Y%m%d}{kind}.csv"
        feed.select(*columns).write.option("header", True).csv(target)


_FEED_ROWS = (
    "CAST(9 + o_custkey % 9 AS VARCHAR) || ':30' AS Time, CAST(o_custkey AS VARCHAR) AS Patient, "
    "substring(o_orderpriority, 1, 1) AS Doctor, strftime(o_orderdate, '%Y%m%d') AS Procedure, "
    "printf('%.2f', o_totalprice) AS Charge"
)


def _written_visits(t) -> str:
    folder = scratch_path(t.spark, "feeds")
    write_feeds(visit_feeds(t), folder, "Visits", DAY)
    return folder


def _one_frame(feeds):
    first, second, third = feeds
    return first.unionByName(second).unionByName(third)


_CLINIC = "CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '2' ELSE '3' END AS Clinic"
_SENDER = "CASE o_orderstatus WHEN 'F' THEN 'Bellevue' WHEN 'O' THEN 'Kirkland' ELSE 'Redmond' END AS Sender"


@query(
    "s1_read_feed",
    f"SELECT {_SENDER}, {_CLINIC}, {_FEED_ROWS}, '2010-01-02' AS FileDay FROM orders",
)
def _(t):
    """Every clinic's file, read by its declared layout with a checked header; one has no clinic number."""
    folder = _written_visits(t)

    def feed(clinic):
        rows = read_feed(t.spark, folder, clinic, "Visits")
        return rows if "Clinic" in rows.columns else rows.withColumn("Clinic", F.lit(None).cast("string"))

    return _one_frame(feed(clinic).withColumn("Sender", F.lit(clinic)) for clinic in CLINICS)


@query("s1_read_feed_by_header", f"SELECT {_SENDER}, {_CLINIC}, {_FEED_ROWS} FROM orders")
def _(t):
    """The same files bound by their headers alone."""
    folder = _written_visits(t)

    def feed(clinic):
        rows = read_feed_by_header(t.spark, f"{folder}/{clinic}/20100102Visits.csv")
        return rows.withColumn("Sender", F.lit(clinic))

    first, second, third = (feed(clinic) for clinic in CLINICS)
    return second.unionByName(third).unionByName(first, allowMissingColumns=True)


_LINES = (
    "SELECT CAST(o_custkey AS VARCHAR) AS Patient_, substring(o_orderpriority, 1, 1) AS Doctor_, o_orderkey FROM orders"
)


@query(
    "s1_rejected_lines",
    "SELECT 'Kirkland' AS Clinic, 'Visits' AS Kind, '20100102Visits.csv' AS File, "
    "CASE WHEN o_orderkey % 3 = 0 THEN '9:30,' || Patient_ || ',2,' || Doctor_ || ',1' "
    "ELSE '9:30,' || Patient_ || ',2,' || Doctor_ || ',1,10.00,more' END AS Line "
    f"FROM ({_LINES}) WHERE o_orderkey % 3 < 2 "
    "UNION ALL SELECT 'Kirkland', 'Visits', '20100102Visits.csv', 'fits: ' || CAST(count(*) AS VARCHAR) "
    f"FROM ({_LINES}) WHERE o_orderkey % 3 = 2",
)
def _(t):
    """A file in which a third of the lines lack a field and a third have one too many; and how many fit."""
    folder = scratch_path(t.spark, "feeds")
    head = [F.lit("9:30,"), c("o_custkey").cast("string"), F.lit(",2,"), F.substring("o_orderpriority", 1, 1)]
    turn = c("o_orderkey") % 3
    tail = F.when(turn == 0, ",1").when(turn == 1, ",1,10.00,more").otherwise(",1,10.00")
    lines = t.orders.select(F.concat(*head, tail).alias("Time,Patient,Clinic,Doctor,Procedure,Charge"))
    # No quoting, and the whole line as one field: the file is as a clinic might send it.
    target = f"{folder}/Kirkland/{DAY:%Y%m%d}Visits.csv"
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(target)
    fit = read_feed(t.spark, folder, "Kirkland", "Visits", on_bad_line="skip")
    counted = fit.agg(F.concat(F.lit("fits: "), F.count("Charge").cast("string")).alias("Line")).select(
        F.lit("Kirkland").alias("Clinic"), F.lit("Visits").alias("Kind"), F.lit("20100102Visits.csv").alias("File"), "Line"
    )
    return rejected_lines(t.spark, folder, "Kirkland", "Visits").unionByName(counted)


@query("s2_conform_feeds", f"SELECT {_CLINIC}, {_FEED_ROWS} FROM orders")
def _(t):
    """Three layouts, one shape."""
    return _one_frame(read_feeds(t.spark, _written_visits(t), "Visits").values()).drop("FileDay")


@query("s3_stage_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    """Two runs: the second copy replaces the first."""
    path = scratch_path(t.spark, "stage")
    stage_table(t.spark, t.customer, path)
    return stage_table(t.spark, f"{t.folder}/customer.parquet", path).select("c_custkey", "c_name", "c_acctbal")


@query("s4_read_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t):
    return read_table(t.spark, f"{t.folder}/supplier.parquet").select("s_suppkey", "s_name", "s_acctbal")


@query("s5_append_rows", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    path = scratch_path(t.spark, "append")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    append_rows(orders.where("o_orderstatus = 'F'"), path)
    append_rows(orders.where("o_orderstatus <> 'F'"), path)
    return read_table_or_empty(t.spark, path, orders.schema)


@query(
    "s6_full_refresh",
    with_model("SELECT row_number() OVER (ORDER BY ClinicID) AS ClinicKey, * FROM clinics_src"),
)
def _(t):
    """Two refreshes: keys start at 1 again."""
    table = SnapshotTable(t.spark, scratch_path(t.spark, "refresh"), WAREHOUSE["dim_clinics"])
    source = D.dim_clinics_src(M.clinics(t))
    full_refresh(source, table, "ClinicKey", ["ClinicID"])
    return full_refresh(source, table, "ClinicKey", ["ClinicID"])


@query(
    "s7_commit_snapshot",
    with_model("SELECT DoctorID + 1 AS DoctorKey, * FROM doctors_src WHERE DoctorState <> 'W A'"),
)
def _(t):
    """The second version is computed from the first and replaces it."""
    table = SnapshotTable(t.spark, scratch_path(t.spark, "snapshot"), WAREHOUSE["dim_doctors"])
    rows = D.dim_doctors_src(M.doctors(t)).select((c("DoctorID") + 1).alias("DoctorKey"), *D.DOCTOR)
    first = commit_snapshot(rows, table, key="DoctorKey")
    commit_snapshot(first.where("DoctorState <> 'W A'"), table, key="DoctorKey")
    return table.read()


@query(
    "s8_date_spine",
    with_model(
        "SELECT CAST(strftime(FullDate, '%Y%m%d') AS BIGINT) AS DateID, CAST(FullDate AS VARCHAR) AS FullDate, "
        "count(o_orderkey) AS n_orders FROM spine LEFT JOIN orders ON CAST(o_orderdate AS DATE) = FullDate GROUP BY ALL"
    ),
)
def _(t):
    """Every day with its orders, also the days without any."""
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("FullDate")).agg(
        F.count("*").alias("n_orders")
    )
    return (
        date_spine(t.spark, *M.VISIT_DAYS)
        .join(per_day, "FullDate", "left")
        .select("DateID", "FullDate", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))
    )


@query(
    "s9_literal_rows",
    with_model(
        "SELECT DoctorID, DoctorFullName FROM doctors_src UNION ALL SELECT 0, 'Unknown' UNION ALL SELECT -1, 'TestIns'"
    ),
)
def _(t):
    extra = [(UNKNOWN_DOCTOR[1], UNKNOWN_DOCTOR[2]), (-1, "TestIns")]
    rows = literal_rows(t.spark, extra, "DoctorID bigint, DoctorFullName string")
    return D.dim_doctors_src(M.doctors(t)).select("DoctorID", "DoctorFullName").unionByName(rows)


def _event_log(t):
    return t.events.select(
        (c("event_id") + 1).alias("ETLLogID"),
        c("ts").alias("ETLDateAndTime"),
        c("event_type").alias("ETLAction"),
        c("props").alias("ETLLogMessage"),
    )


@query(
    "s10_log_event",
    "SELECT event_id + 1 AS ETLLogID, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ETLDateAndTime, event_type AS ETLAction, "
    "props AS ETLLogMessage FROM events UNION ALL "
    "SELECT max(event_id) + 2, '2024-03-10 19:13:00', 'sync', 'done' FROM events",
)
def _(t):
    return log_event(_event_log(t), "sync", "done", datetime(2024, 3, 10, 19, 13))


@query(
    "s11_log_view",
    "SELECT event_id + 1 AS ETLLogID, strftime(ts, '%A, %B ') || CAST(day(ts) AS VARCHAR) || strftime(ts, ', %Y') AS ETLDate, "
    "strftime(ts, '%H:%M') AS ETLTime, event_type AS ETLAction, props AS ETLLogMessage FROM events",
)
def _(t):
    return log_view(_event_log(t))


# --- jobs --------------------------------------------------------------------------------------

_LOADED = (
    "SELECT row_number() OVER (ORDER BY Date, Clinic, Patient, Doctor, Procedure, Charge) AS ID, "
    + VISITS_OUT.removeprefix("SELECT ")
    + " FROM arrived"
)


def _loaded_twice(t) -> Operational:
    """Both kinds of files of three clinics, loaded twice; the second run adds nothing."""
    spark = t.spark
    folder, into = scratch_path(spark, "feeds"), Operational(scratch_path(spark, "operational"))
    write_feeds(patient_feeds(t), folder, "NewPatients", DAY)
    write_feeds(visit_feeds(t), folder, "Visits", DAY)
    load_daily_files(spark, folder, into, DAY)
    again = load_daily_files(spark, folder, into, DAY)
    assert again == {"patients": 0, "visits": 0}, again
    return into


@query(
    "x1_daily_files",
    f"WITH {ARRIVED_VISITS.format(day=chr(39).join(['TIMESTAMP ', '2010-01-02', '']))} {_LOADED}",
)
def _(t):
    """The visits after the daily load."""
    return _loaded_twice(t).visits(t.spark).drop("VisitDay")


@query(
    "x1_daily_patients",
    with_model(
        "SELECT row_number() OVER (ORDER BY FName NULLS FIRST, LName, Email NULLS FIRST, Address, City, State, "
        "ZipCode NULLS FIRST) AS ID, * FROM arrived",
        PATIENTS_ARRIVED,
    ),
)
def _(t):
    """The patients after the daily load."""
    return _loaded_twice(t).patients(t.spark)


_TWO_DAYS = "CASE WHEN o_orderdate < DATE '1998-01-01' THEN TIMESTAMP '2010-01-02' ELSE TIMESTAMP '2010-01-03' END"


@query(
    "x1_reconcile",
    "WITH "
    + ARRIVED_VISITS.format(day=_TWO_DAYS)
    + "SELECT 'visits' AS table_name, count(*) FILTER (WHERE Date < DATE '2010-01-03') AS rows_before, "
    "count(*) FILTER (WHERE Date >= DATE '2010-01-03') AS rows_added, count(*) AS rows_after, CAST(1 AS BIGINT) AS balanced FROM arrived",
)
def _(t):
    """Two days loaded one after the other: rows before, reported as added, and after the second."""
    spark = t.spark
    folder, into = scratch_path(spark, "feeds"), Operational(scratch_path(spark, "operational"))
    early = c("FileDay") < F.lit("1998-01-01").cast("date")
    added, before = {}, 0
    write_feeds(patient_feeds(t), folder, "NewPatients", DAY)
    write_feeds(patient_feeds(t), folder, "NewPatients", date(2010, 1, 3))
    for day, part in ((DAY, early), (date(2010, 1, 3), ~early)):
        write_feeds({clinic: feed.where(part) for clinic, feed in visit_feeds(t).items()}, folder, "Visits", day)
        before = into.visits(spark).count()
        added[day] = load_daily_files(spark, folder, into, day)["visits"]
    after = into.visits(spark)
    return reconcile(spark.range(before), after, spark.range(added[date(2010, 1, 3)]), "visits")


def warehouse_sources(t) -> dict:
    return {
        "clinics": M.clinics(t),
        "doctors": M.doctors(t),
        "doctor_shifts": M.doctor_shifts(t),
        "shifts": M.shifts(t),
        "patients": M.patients(t),
        "procedures": M.procedures(t),
        "visits": M.visits(t),
    }


def _warehouse(t, table: str):
    """The whole warehouse from nothing, and one table of it; the calendar holds the visits' and the shifts' days."""
    spark = t.spark
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    staged = stage_sources(spark, warehouse_sources(t), warehouse.root)
    load_warehouse(
        warehouse, staged, DAY, datetime(2010, 1, 2, 1), days=M.ALL_DAYS, spine=date_spine(spark, *M.ALL_DAYS)
    )
    return warehouse.read(table)


@query(
    "x2_warehouse",
    with_model("SELECT * REPLACE (CAST(ProcedureVistCharge AS DOUBLE) AS ProcedureVistCharge) FROM fact_visits"),
)
def _(t):
    """The visit fact of the whole load."""
    return _warehouse(t, "fact_visits")


@query(
    "x2_shift_fact",
    with_model(
        "SELECT DoctorsShiftID, date_diff('day', DATE '1995-01-01', ShiftDate) + 1 AS ShiftDateKey, ClinicKey, ShiftKey, "
        "DoctorKey, abs(CAST(ShiftEnd[1:2] AS BIGINT) - CAST(ShiftStart[1:2] AS BIGINT)) AS HoursWorked "
        "FROM doctor_shifts JOIN dim_clinics USING (ClinicID) JOIN dim_shifts USING (ShiftID) JOIN dim_doctors USING (DoctorID)"
    ),
)
def _(t):
    """The shift fact of the whole load."""
    return _warehouse(t, "fact_doctor_shifts")


@query(
    "x2_doctors",
    with_model("SELECT * FROM dim_doctors UNION ALL SELECT 0, 0, 'Unknown (Deleted)', 'Unknown', 'Unknown', 'Unknown', '00000'"),
)
def _(t):
    """The doctors of the whole load, the unknown one marked by the sync."""
    return _warehouse(t, "dim_doctors")


@query(
    "x3_streamed_files",
    "WITH "
    + ARRIVED_VISITS.format(day=_TWO_DAYS)
    + _LOADED,
)
def _(t):
    """Files of two days arrive one after the other; each is picked up once, and numbered as in the batch load."""
    spark = t.spark
    folder, into = scratch_path(spark, "feeds"), Operational(scratch_path(spark, "operational"))
    checkpoints = scratch_path(spark, "streams")
    early = c("FileDay") < F.lit("1998-01-01").cast("date")
    write_feeds(patient_feeds(t), folder, "NewPatients", DAY)
    for day, part in ((DAY, early), (date(2010, 1, 3), ~early)):
        feeds = {clinic: feed.where(part) for clinic, feed in visit_feeds(t).items()}
        write_feeds(feeds, folder, "Visits", day)
        load_new_files(spark, folder, into, checkpoints)
    return into.visits(spark).drop("VisitDay")
