"""Warehouse load: sync six dimensions, then merge two facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial
from math import ceil
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.operators.merge import applied, change_counts, fact_merge, merged_in_parts
from starward.operators.quality import UNIQUE, keys_rule, reference_violations, split_by_reference, warehouse_violations
from starward.operators.sync import scd1_actions, scd1_changes_anything, scd1_sync
from starward.plans import dimensions as D
from starward.plans.facts import SHIFT_FACT, VISIT_FACT, fact_shifts_src, fact_visits_src
from starward.plans.together import results_of, together
from starward.schemas import UNKNOWN_DOCTOR, WAREHOUSE
from starward.session import hashed_joins
from starward.sources.generated import date_spine
from starward.sources.history import HistoryTable
from starward.sources.ledger import LossLedger, append_counts, read_counts
from starward.sources.parts import PartTable, digests
from starward.sources.runlog import append_events
from starward.sources.scratch import staged
from starward.sources.snapshots import SnapshotTable
from starward.sources.tables import append_rows, read_table_or_empty, stage_table

#: Sources that are copied before the load.  Visits are read where they are, as they were when
#: the fact is built.
STAGED = ("clinics", "doctors", "doctor_shifts", "shifts", "patients", "procedures")


#: Facts are stored by the month of their day.
MONTH = T.StructField("MonthID", T.IntegerType())
#: A month's rows are merged and written by one task for each so many of them.
SLOT_ROWS = 250_000


@dataclass(frozen=True)
class Warehouse:
    """The tables of the star under one folder.

    Facts are stored in months, patients as a growing history, and the other dimensions as whole snapshots.
    """

    spark: SparkSession
    root: str

    def table(self, name: str) -> SnapshotTable | PartTable | HistoryTable:
        folder, schema = f"{self.root}/{name}", WAREHOUSE[name]
        if name.startswith("fact_"):
            return PartTable(self.spark, folder, schema, MONTH)
        if name == "dim_patients":
            return HistoryTable(self.spark, folder, schema, "PatientKey")
        return SnapshotTable(self.spark, folder, schema)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    @property
    def log_path(self) -> str:
        return f"{self.root}/etl_log"

    @property
    def counts_path(self) -> str:
        return f"{self.root}/etl_counts"

    def counts(self) -> DataFrame:
        """What each run counted of itself: ``run_at, table_name, part, n_rows``."""
        return read_counts(self.spark, self.counts_path)

    def rejects(self, name: str) -> DataFrame:
        """Rows of a fact that a run set aside, with the reason."""
        schema = T.StructType([*WAREHOUSE[name].fields, T.StructField("reason", T.StringType())])
        return read_table_or_empty(self.spark, f"{self.root}/rejects/{name}", schema)

    def retire(self, keep: int = 1) -> int:
        """Delete what only versions before each table's last ``keep`` need; returns the folders deleted.

        The growing history of patients has no older versions.  Readers of older versions must have ended.
        """
        tables = [self.table(n) for n in WAREHOUSE if n not in ("etl_log", "dim_patients")]
        return sum(t.retire(keep) for t in tables)

    def log(self) -> DataFrame:
        return read_table_or_empty(self.spark, self.log_path, WAREHOUSE["etl_log"])


class Violation(ValueError):
    """Rows about to be committed break a rule of their table."""


def guard(
    name: str, on_violation: str, told: dict[str, str], dimensions: Callable[[], Mapping[str, DataFrame]] | None = None
) -> Callable[..., None]:
    """A check for a commit: ``"block"`` raises, ``"report"`` leaves the text in ``told``.

    With ``dimensions`` the references of a fact are checked too.  Only what was written is checked: a key of a fact holds its day, so
    it can repeat within its month only.  Who has counted the rows that share their key already passes the number as ``repeated``.
    """

    def check(written: DataFrame, repeated: int | None = None) -> None:
        rules = warehouse_violations(name, written, keys=repeated is None)
        if dimensions is not None:
            rules = rules.unionByName(reference_violations(name, written, dimensions()))
        found = {r["rule"]: r["rows"] for r in rules.collect()}  # a row a rule
        if repeated:
            found[keys_rule(name)] = repeated
        if not found:
            return
        text = "; ".join(sorted(f"{rule}: {n} rows" for rule, n in found.items()))
        if on_violation != "report":
            raise Violation(f"{name} not committed, {text}")
        told[name] = text

    return check


def stage_sources(
    spark: SparkSession, sources: Mapping[str, DataFrame], root: str
) -> dict[str, DataFrame]:
    """Copy the six staged sources; the visits stay in place."""
    copies = results_of(
        spark, {n: partial(stage_table, spark, sources[n], f"{root}/staged/{n}") for n in STAGED}
    )
    return copies | {"visits": sources["visits"]}


def sync_type1(
    table: SnapshotTable,
    source: DataFrame,
    columns: list[str],
    key: str,
    dim: DataFrame | None = None,
    check: Callable[[DataFrame], None] | None = None,
    **how,
) -> DataFrame:
    """One type 1 sync, committed if anything differs.  New keys start above every key the table ever had."""
    dim = table.read() if dim is None else dim
    actions = scd1_actions(dim, source, columns[0], columns, key)
    effect = {k: v for k, v in how.items() if k in ("name_column", "on_delete", "protect_keys")}
    if table.version and not scd1_changes_anything(dim, actions, columns[0], key, **effect):
        return table.read()
    state = scd1_sync(dim, source, columns[0], columns, key, start=table.high_water, actions=actions, **how)
    return table.commit(state, key=key, check=check)


def with_unknown_doctor(doctors: DataFrame) -> DataFrame:
    """The doctors, with the key 0 member unless it is there already."""
    if not doctors.where("DoctorKey = 0").isEmpty():
        return doctors
    return D.with_unknown_member(doctors, UNKNOWN_DOCTOR, WAREHOUSE["dim_doctors"])


def merge_facts(
    table: PartTable,
    source: DataFrame,
    columns: list[str],
    unique: bool = False,
    check: Callable[..., None] | None = None,
    keys: Sequence[str] = (),
) -> dict[str, int]:
    """Merge, and commit the months that changed; returns the rows inserted and deleted.

    ``source`` has the table's part column too.  It is written once, and its digest of each month is held against the one in the
    last commit: months that agree are neither read nor shuffled.  In the others one shuffle finds the changes, which are written and
    counted; a month's new rows are its old ones less what goes and plus what comes.  Without changes there is no new version.

    A row with a NULL, which matches nothing, is deleted and inserted again only where its month differs in something.

    With the ``keys`` of rows that hardly ever occur twice, the same shuffle also gives the months' new rows and how many
    of them share their keys, which ``check`` gets as ``repeated``; nothing is written in between.

    A table without a commit has nothing to be held against: the source goes into its months as it is read.
    """
    by = table.by.name
    if table.version == 0:
        written = table.commit(source.select(*columns, by), check=check)
        return {"inserted": sum(p.rows for p in written), "deleted": 0}
    arrived = staged(source.select(*columns, by), "fact-source")
    theirs = digests(arrived, by, table.schema)
    ours: dict[str, tuple] = {}
    for p in table.parts():
        n, d = ours.get(p.part, (0, 0))
        ours[p.part] = (n + p.rows, d + p.digest)
    differing = sorted(p for p in theirs.keys() | ours.keys() if theirs.get(p) != ours.get(p))
    nothing = {"inserted": 0, "deleted": 0}
    if not differing:
        return nothing
    fact = table.read(differing, stored=True)
    part_of_row = F.col(by).cast("string")
    some = arrived.where(part_of_row.isin(differing) | part_of_row.isNull())
    both = [*columns, by]
    if unique and keys:
        slots = ceil(max(n for n, _ in [*theirs.values(), *ours.values()]) / SLOT_ROWS)
        return _merge_in_parts(table, fact, some, both, keys, slots, differing, check)
    changes = staged(fact_merge(fact, some, both, unique).changes, "fact-changes")
    counts = change_counts(changes)
    if any(counts.values()):
        table.commit(applied(fact, changes, both, unique), replace=differing, check=check)
    return counts


class _Unchanged(Exception):
    """Nothing came or went, so what was written isn't made current."""


def _merge_in_parts(
    table: PartTable,
    fact: DataFrame,
    source: DataFrame,
    columns: list[str],
    keys: Sequence[str],
    slots: int,
    replace: list[str],
    check: Callable[..., None] | None,
) -> dict[str, int]:
    state, moved, repeated = merged_in_parts(fact, source, columns, table.by.name, keys, slots)

    def check_changed(written: DataFrame) -> None:
        if not any(moved.get.values()):
            raise _Unchanged
        if check is not None:
            check(written, repeated=repeated.get["n"])

    with suppress(_Unchanged):
        table.commit(state, replace=replace, check=check_changed, rebalance=False)
    return {name: n or 0 for name, n in moved.get.items()}


def load_warehouse(
    warehouse: Warehouse,
    sources: Mapping[str, DataFrame],
    as_of: date,
    now: datetime,
    days: tuple[date, date] = D.WAREHOUSE_DAYS,
    spine: DataFrame | None = None,
    unknown: str = "drop",
    reclose: bool = True,
    protect_unknown: bool = False,
    on_violation: str = "block",
) -> None:
    """One run: the dimensions, then the facts, which look up the dimensions' keys.

    Steps of a group do not depend on each other and run together.  Each commits by itself and
    leaves a row in the log, always in the same order.  A failed step logs its error and leaves
    its table as it was; the facts are merged only if every dimension succeeded.

    ``protect_unknown`` keeps the type 1 sync from marking the unknown doctor as deleted.

    What a step has written is checked before it is made current: no missing, too long or unallowed value, no key
    twice, no reference to a member that isn't there.  With ``on_violation="block"`` a table that breaks a rule stays as it was and
    its step fails; ``"report"`` commits it and leaves the rules and their numbers of rows in the log; ``"reject"`` is as ``"block"``, but
    sets fact rows without a member aside first (``Warehouse.rejects``).

    Every table's rows before, added, gone and after, and what each lookup of a fact dropped, go to ``Warehouse.counts``.
    """
    if on_violation not in ("block", "report", "reject"):
        raise ValueError(f"on_violation is block, report or reject, not {on_violation}")
    w, spark = warehouse, warehouse.spark
    told: dict[str, str] = {}
    dims = [name for name in WAREHOUSE if name.startswith("dim_")]

    def dimensions() -> dict[str, DataFrame]:
        return {name: w.read(name) for name in dims}

    checks = {name: guard(name, on_violation, told) for name in dims}
    checks |= {name: guard(name, on_violation, told, dimensions) for name in WAREHOUSE if name.startswith("fact_")}
    counted: dict[str, list[tuple[str, str, int]]] = {}
    spine = date_spine(spark) if spine is None else spine
    protected = {"protect_keys": (0,)} if protect_unknown else {}

    def clinics():
        sync_type1(w.table("dim_clinics"), D.dim_clinics_src(sources["clinics"]), D.CLINIC,
                   "ClinicKey", name_column="ClinicName", check=checks["dim_clinics"])

    def doctors():
        # The member is there before the sync, which marks it as deleted unless it is protected.
        table = w.table("dim_doctors")
        sync_type1(table, D.dim_doctors_src(sources["doctors"]), D.DOCTOR, "DoctorKey",
                   dim=with_unknown_doctor(table.read()), name_column="DoctorFullName",
                   check=checks["dim_doctors"], **protected)

    def patients():
        return w.table("dim_patients").merge(
            D.dim_patients_src(sources["patients"]), D.PATIENT, as_of, reclose=reclose, check=checks["dim_patients"], unique=True
        )

    def procedures():
        sync_type1(w.table("dim_procedures"), D.dim_procedures_src(sources["procedures"]),
                   D.PROCEDURE, "ProcedureKey", name_column="ProcedureName", check=checks["dim_procedures"])

    def shifts():
        sync_type1(w.table("dim_shifts"), D.dim_shifts_src(sources["shifts"]), D.SHIFT,
                   "ShiftKey", on_delete="drop", check=checks["dim_shifts"])

    def dates():
        sync_type1(w.table("dim_dates"), D.dim_dates_src(spine, *days), D.DAY,
                   "DateKey", on_delete="drop", unique=True, check=checks["dim_dates"])

    def fact(name: str, source: DataFrame, columns: list[str], ledger: LossLedger, unique: bool = False):
        table = w.table(name)
        before = table.rows()
        rejected = None
        if on_violation == "reject":
            source, rejected = split_by_reference(name, staged(source, "fact-source"), dimensions())
            rejected = staged(rejected.select(*WAREHOUSE[name].names, "reason"), "rejected")
            append_rows(rejected, f"{w.root}/rejects/{name}")
        counts = merge_facts(table, source, columns, unique=unique, check=checks[name], keys=UNIQUE[name])
        steps = {"before": before, "added": counts["inserted"], "gone": counts["deleted"], "after": table.read().count()}
        steps |= {"read": ledger.counts()["read"], **{f"dropped by {d}": n for d, n in ledger.losses().items()}}
        if rejected is not None:
            steps["rejected"] = rejected.count()
        counted[name] = [(name, part, n) for part, n in steps.items()]
        return counts

    def doctor_shifts():
        ledger = LossLedger()
        source = fact_shifts_src(
            sources["doctor_shifts"], w.read("dim_dates"), w.read("dim_clinics"),
            w.read("dim_shifts"), w.read("dim_doctors"), unknown, month=True, ledger=ledger,
        )
        return fact("fact_doctor_shifts", source, SHIFT_FACT, ledger)

    def visits():
        ledger = LossLedger()
        source = fact_visits_src(
            sources["visits"], w.read("dim_dates"), w.read("dim_clinics"),
            w.table("dim_patients").current(), w.read("dim_doctors"), w.read("dim_procedures"), unknown, month=True, ledger=ledger,
        )
        # The source is grouped by its keys, so no row occurs twice.
        return fact("fact_visits", source, VISIT_FACT, ledger, unique=True)

    _run_and_log(
        w,
        {
            "dim_clinics": clinics,
            "dim_doctors": doctors,
            "dim_patients": patients,
            "dim_procedures": procedures,
            "dim_shifts": shifts,
            "dim_dates": dates,
        },
        now,
        told,
    )
    with hashed_joins(spark):
        _run_and_log(w, {"fact_doctor_shifts": doctor_shifts, "fact_visits": visits}, now, told)
    append_counts(spark, w.counts_path, [row for name in sorted(counted) for row in counted[name]], now)


def _run_and_log(
    w: Warehouse, steps: Mapping[str, Callable[[], Any]], now: datetime, told: Mapping[str, str]
) -> None:
    """Run independent steps together, log each in its order, then raise the first failure."""
    failure, events = None, []
    for name, result in together(w.spark, steps).items():
        if isinstance(result, Exception):
            failure, note = failure or result, str(result)
        else:
            note = f"{name} synced"
            if isinstance(result, dict) and "inserted" in result:
                note += f": {result['inserted']} inserted, {result['deleted']} deleted"
            if name in told:
                note += f"; broken rules: {told[name]}"
        events.append((f"sync {name}", note))
    append_events(w.spark, w.log_path, events, now)
    if failure:
        raise failure
