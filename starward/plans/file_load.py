"""Daily file load: three clinics' files into the operational tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.functions.clock import visit_time
from starward.functions.codes import clinic_number
from starward.functions.text import marked_email
from starward.operators.keys import assign_keys
from starward.operators.setops import except_loaded, under_collation, union_distinct
from starward.schemas import CLINIC_WITHOUT_NUMBER, FEED_SCHEMAS, OPERATIONAL, PATIENT_COLUMNS, VISIT_COLUMNS
from starward.sources.feeds import delivered_files, delivery_states, read_feeds
from starward.sources.parts import PartTable
from starward.sources.scratch import staged

#: Physical partition column of the visits table; not part of its rows.
VISIT_DAY = "VisitDay"
STORED_VISITS = T.StructType([*OPERATIONAL["visits"].fields, T.StructField(VISIT_DAY, T.DateType())])


def flag_invalid_email(df: DataFrame, column: str = "Email") -> DataFrame:
    return df.withColumn(column, marked_email(F.col(column)))


def patient_rows(feed: DataFrame) -> DataFrame:
    """A conformed feed with checked addresses and the operational types."""
    zip_code = F.col("ZipCode").cast("int").alias("ZipCode")
    return flag_invalid_email(feed).select(*PATIENT_COLUMNS[:-1], zip_code)


def visit_rows(feed: DataFrame, clinic: str, day: date | Column) -> DataFrame:
    """A conformed feed with clinic numbers, full times and the operational types."""
    day = day if isinstance(day, Column) else F.lit(day)
    numbered = "Clinic" in FEED_SCHEMAS[(clinic, "Visits")].names
    number = clinic_number(F.col("Clinic")) if numbered else F.lit(CLINIC_WITHOUT_NUMBER)
    return feed.select(
        visit_time(day, F.col("Time")).alias("Date"),
        number.alias("Clinic"),
        F.col("Patient").cast("bigint").alias("Patient"),
        F.col("Doctor").cast("bigint").alias("Doctor"),
        F.col("Procedure").cast("bigint").alias("Procedure"),
        F.col("Charge").cast("decimal(19,4)").alias("Charge"),
    )


def arrived_patients(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """The distinct patients of all feeds."""
    return union_distinct(*map(patient_rows, feeds.values()))


def arrived_visits(feeds: Mapping[str, DataFrame], day: date | None = None) -> DataFrame:
    """The distinct visits of all feeds; without ``day`` a row's day comes from its file's name."""
    at = F.col("FileDay") if day is None else day
    return union_distinct(*[visit_rows(f, clinic, at) for clinic, f in feeds.items()])


def new_patients(
    feeds: Mapping[str, DataFrame], patients: DataFrame, collation: str | None = None
) -> DataFrame:
    """Patients of all feeds that are not loaded yet.

    All columns count: a known patient with a new address is a new patient.
    """
    return unknown_patients(staged(arrived_patients(feeds), "patients-arrived"), patients, collation)


def unknown_patients(
    arrived: DataFrame, patients: DataFrame, collation: str | None = None, loaded_distinct: bool = False
) -> DataFrame:
    """Distinct arrived patients that ``patients`` lacks; ``loaded_distinct`` says that those hold hardly any duplicates.

    The comparison looks at ``arrived`` twice, so it should be a written table: the text is then parsed
    once, and its true size is known.
    """
    loaded = under_collation(patients.select(*PATIENT_COLUMNS), collation)
    if collation is None:
        return except_loaded(arrived, loaded, distinct=True, loaded_distinct=loaded_distinct)
    fresh = except_loaded(under_collation(arrived, collation).distinct(), loaded, distinct=True)
    plain = OPERATIONAL["patients"]
    return fresh.select(*[F.col(c).cast(plain[c].dataType) for c in PATIENT_COLUMNS])


def new_visits(
    feeds: Mapping[str, DataFrame], visits: DataFrame, day: date | None = None
) -> DataFrame:
    """Visits of all feeds that are not loaded yet.

    Every feed row falls on ``day``, so only that day's loaded rows can equal one; the filter
    reaches the file scan.
    """
    loaded = visits if day is None else loaded_between(visits, day, day)
    arrived = staged(arrived_visits(feeds, day), "visits-arrived")
    return except_loaded(arrived, loaded.select(*VISIT_COLUMNS), distinct=True)


def loaded_between(visits: DataFrame, first: date, last: date) -> DataFrame:
    """Loaded visits that may equal a feed row of these days, rows without a date included."""
    at = F.col("Date")
    begin = F.lit(first).cast("timestamp_ntz")
    end = F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    rows = visits.where(at.isNull() | ((at >= begin) & (at < end)))
    if VISIT_DAY in visits.columns:
        day = F.col(VISIT_DAY)
        rows = rows.where(day.isNull() | day.between(F.lit(first), F.lit(last)))
    return rows


def loaded_on(visits: DataFrame, days: DataFrame) -> DataFrame:
    """Stored visits of the days in ``days (VisitDay)``, and those without a day.

    Only the days themselves are read, however far apart they lie: the days are a small table, whose
    values prune the partitions of the visits.
    """
    dated = visits.join(days.where(F.col(VISIT_DAY).isNotNull()), VISIT_DAY, "left_semi")
    return dated.unionByName(visits.where(F.col(VISIT_DAY).isNull()))


def visits_in_order(new: DataFrame) -> DataFrame:
    """The review order: date, clinic.

    The other columns break ties, so a crowded time slot spreads over several sort partitions.
    """
    return new.orderBy("Date", "Clinic", *[c for c in new.columns if c not in ("Date", "Clinic")])


#: What is kept of each delivered file.
FILES = T.StructType(
    [
        T.StructField("Clinic", T.StringType()),
        T.StructField("Kind", T.StringType()),
        T.StructField("File", T.StringType()),
        T.StructField("Lines", T.LongType()),
        T.StructField("Digest", T.DecimalType(38, 0)),
        T.StructField("State", T.StringType()),
    ]
)


class Redelivered(ValueError):
    """A file that was loaded came again with other content."""


@dataclass(frozen=True)
class Operational:
    """Where the two operational tables and the list of loaded files lie.

    A load's rows are a folder of their own for each day, and one commit row makes them visible.
    """

    root: str

    def patients_table(self, spark: SparkSession) -> PartTable:
        return PartTable(spark, f"{self.root}/patients", OPERATIONAL["patients"])

    def visits_table(self, spark: SparkSession) -> PartTable:
        return PartTable(spark, f"{self.root}/visits", STORED_VISITS, STORED_VISITS[VISIT_DAY])

    def files_table(self, spark: SparkSession) -> PartTable:
        return PartTable(spark, f"{self.root}/files", FILES)

    def patients(self, spark: SparkSession) -> DataFrame:
        return self.patients_table(spark).read()

    def visits(self, spark: SparkSession) -> DataFrame:
        return self.visits_table(spark).read()

    def files(self, spark: SparkSession) -> DataFrame:
        """Every file loaded, once for each content it came with."""
        return self.files_table(spark).read()


def _append_numbered(fresh: DataFrame, table: PartTable, batch: str | None) -> int:
    """Give new rows their IDs, in the order of their columns, and append them; returns how many.

    The rows are distinct already.  The commit that shows them also keeps the highest ID, so a load that dies before it has given out
    none.

    Numbering reads the rows twice, for the bounds of its ranges and to sort them.  Where there is a history to compare with, they are
    written first, so that the comparison runs once.
    """
    if table.version:
        fresh = staged(fresh, "fresh")
    if fresh.isEmpty():
        return 0
    numbered = assign_keys(fresh, "ID", order_by=fresh.columns, start=table.high_water, unique=True)
    if table.by is not None:
        numbered = numbered.withColumn(VISIT_DAY, F.to_date("Date"))
    return sum(p.rows for p in table.commit(numbered, replace=(), key="ID", batch=batch))


def append_patients(
    spark: SparkSession, arrived: DataFrame, into: Operational, collation: str | None = None, batch: str | None = None
) -> int:
    """Append the distinct arrived patients that are not loaded yet; returns how many.

    The checked rows are written once: the text is parsed once and its true size is known.  ``batch`` names what brought them.
    """
    table = into.patients_table(spark)
    fresh = unknown_patients(staged(arrived, "patients-arrived"), table.read(), collation, loaded_distinct=True)
    return _append_numbered(fresh, table, batch)


def append_visits(spark: SparkSession, arrived: DataFrame, into: Operational, batch: str | None = None) -> int:
    """Append the distinct arrived visits that are not loaded yet; returns how many.

    IDs follow date, then clinic.  Rows can only equal loaded ones of their day: the manifest gives the folders of the feed's days, and
    no others are listed or read.
    """
    table = into.visits_table(spark)
    arrived = staged(arrived, "visits-arrived")
    days = [r[0] for r in arrived.select(F.to_date("Date")).distinct().collect()]  # a row a day of the feed
    history = table.read([*days, None]).select(*VISIT_COLUMNS)
    return _append_numbered(except_loaded(arrived, history, distinct=True, loaded_distinct=True), table, batch)


def load_daily_files(
    spark: SparkSession,
    folder: str,
    into: Operational,
    day: date | None = None,
    collation: str | None = None,
    on_bad_line: str = "fail",
    on_redelivered: str = "tell",
) -> dict[str, int]:
    """One run: read, check, and append patients, then visits; returns the rows added to each.

    With ``day`` only that day's files are read; without it, all files in the folders.  A second
    run adds nothing.  ``collation`` says how patients' texts compare, ``on_bad_line`` what a line does that
    doesn't fit its layout (``sources.feeds.checked``).

    What each file held is kept (``Operational.files``).  A file that comes again with other content is loaded as any other and listed as
    changed; with ``on_redelivered="fail"`` it ends the load before a row is added.
    """
    if on_redelivered not in ("tell", "fail"):
        raise ValueError(f"on_redelivered is tell or fail, not {on_redelivered}")
    delivered = [delivered_files(spark, folder, kind, day) for kind in ("NewPatients", "Visits")]
    states = staged(delivery_states(delivered[0].unionByName(delivered[1]), into.files(spark)), "delivered")
    if on_redelivered == "fail":
        changed = states.where("State = 'changed'").orderBy("Clinic", "Kind", "File").take(10)
        if changed:
            raise Redelivered("; ".join(f"{r.Clinic}/{r.File} has other content than when it was loaded" for r in changed))
    patients = read_feeds(spark, folder, "NewPatients", day, on_bad_line)
    visits = read_feeds(spark, folder, "Visits", day, on_bad_line)
    added = {
        "patients": append_patients(spark, arrived_patients(patients), into, collation),
        "visits": append_visits(spark, arrived_visits(visits, day), into),
    }
    told = states.where("State <> 'again'")
    if not told.isEmpty():
        into.files_table(spark).commit(told, replace=())
    return added
