"""Table constraints as checks: each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.sources.scratch import staged


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with ``copies``; hot keys combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference is missing in the parent; NULL refers to nothing and passes."""
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    refers = child.where(F.col(column).isNotNull())
    return refers.join(known, F.col(column) == F.col("_known"), "left_anti")


def outside_set(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows with a value that is not allowed; as in a check constraint, NULL passes."""
    return df.where(~F.col(column).isin(*allowed))


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``, and which: one scan for all columns."""
    found = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("missing", found).where(F.size("missing") > 0)


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text over its limit, and which column: one scan for all columns."""
    found = F.array_compact(
        F.array(*[F.when(F.length(F.col(c)) > n, F.lit(c)) for c, n in limits.items()])
    )
    return df.withColumn("too_long", found).where(F.size("too_long") > 0)


def row_violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """All single-row rules in one scan: one output row per broken rule, named in ``rule``.

    A rule is the condition that must hold; NULL counts as holding.
    """
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("rule"))


# Length limits of the warehouse's text columns.
TEXT_LIMITS = {
    "dim_dates": {"FullDateName": 50, "MonthName": 50, "YearName": 50},
    "dim_clinics": {"ClinicName": 100, "ClinicCity": 100, "ClinicState": 100, "ClinicZip": 5},
    "dim_doctors": {
        "DoctorFullName": 200,
        "DoctorEmailAddress": 100,
        "DoctorCity": 100,
        "DoctorState": 100,
        "DoctorZip": 5,
    },
    "dim_procedures": {"ProcedureName": 100, "ProcedureDesc": 1000},
    "dim_patients": {"PatientFullName": 100, "PatientCity": 100, "PatientState": 100},
}

# Columns that may be NULL; every other column may not.
NULLABLE = {"dim_patients": {"EndDate", "IsCurrent"}, "fact_doctor_shifts": {"HoursWorked"}}


def warehouse_row_violations(name: str, table: DataFrame) -> DataFrame:
    """Not-null, length and value rules of one warehouse table, keyed by its first column."""
    return row_violations(table, _row_rules(name, table), table.columns[:1])


def _row_rules(name: str, table: DataFrame) -> dict[str, Column]:
    rules = {
        f"{c} is null": F.col(c).isNotNull()
        for c in table.columns
        if c not in NULLABLE.get(name, ())
    }
    rules |= {f"{c} over {n}": F.length(F.col(c)) <= n for c, n in TEXT_LIMITS.get(name, {}).items()}
    if name == "dim_patients":
        rules["IsCurrent not 0 or 1"] = F.col("IsCurrent").isin(0, 1)
    return rules


# The columns whose values may stand only once; a fact's are all that aren't measures.
UNIQUE = {
    "dim_dates": ["DateKey"],
    "dim_clinics": ["ClinicKey"],
    "dim_doctors": ["DoctorKey"],
    "dim_shifts": ["ShiftKey"],
    "dim_procedures": ["ProcedureKey"],
    "dim_patients": ["PatientKey"],
    "fact_doctor_shifts": ["DoctorsShiftID", "ShiftDateKey", "ClinicKey", "ShiftKey", "DoctorKey"],
    "fact_visits": ["VisitKey", "DateKey", "ClinicKey", "PatientKey", "DoctorKey", "ProcedureKey"],
}


def keys_rule(name: str) -> str:
    return f"{', '.join(UNIQUE[name])} more than once"


def warehouse_violations(name: str, table: DataFrame, keys: bool = True) -> DataFrame:
    """``table, rule, rows``: how many rows of a warehouse table break each of its rules; none if it keeps them.

    Rows are counted for all rules in one pass.  ``keys=False`` leaves out the rule that keys stand once, where that is known already.
    """
    counts = [F.struct(F.lit(rule).alias("rule"), F.count_if(~ok).alias("rows")) for rule, ok in _row_rules(name, table).items()]
    found = table.agg(F.array(*counts).alias("_found")).select(F.inline("_found")).where("rows > 0")
    if keys:
        repeated = duplicate_keys(table, UNIQUE[name]).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).where("rows > 0")
        found = found.unionByName(repeated.select(F.lit(keys_rule(name)).alias("rule"), "rows"))
    return found.select(F.lit(name).alias("table"), "rule", "rows")


# The dimension and key that each key column of a fact refers to.
REFERENCES = {
    "fact_visits": {
        "DateKey": ("dim_dates", "DateKey"),
        "ClinicKey": ("dim_clinics", "ClinicKey"),
        "PatientKey": ("dim_patients", "PatientKey"),
        "DoctorKey": ("dim_doctors", "DoctorKey"),
        "ProcedureKey": ("dim_procedures", "ProcedureKey"),
    },
    "fact_doctor_shifts": {
        "ShiftDateKey": ("dim_dates", "DateKey"),
        "ClinicKey": ("dim_clinics", "ClinicKey"),
        "ShiftKey": ("dim_shifts", "ShiftKey"),
        "DoctorKey": ("dim_doctors", "DoctorKey"),
    },
}


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``column, rows``: the values without a parent and how many rows have each.

    Rows are counted by value before the join, so a hot value is one row there and the join is as large as the values in use.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_column).alias("_known"))
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


def reference_violations(name: str, fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rule, rows``: how many rows of a fact refer to no member of each dimension; none if all do."""
    each = []
    for column, (dimension, key) in REFERENCES[name].items():
        counted = orphan_keys(fact, column, dimensions[dimension], key).agg(F.sum("rows").alias("rows")).where("rows > 0")
        each.append(counted.select(F.lit(name).alias("table"), F.lit(f"{column} not in {dimension}").alias("rule"), "rows"))
    return reduce(DataFrame.unionByName, each)


def split_by_reference(name: str, fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The rows of a fact whose references all exist, and the others with the broken ones in ``reason``.

    The keys that have no parent are few and are found first; the fact then meets only those.
    """
    marked, flags = fact, []
    for column, (dimension, key) in REFERENCES[name].items():
        bad = f"_bad_{column}"
        orphans_ = staged(orphan_keys(fact, column, dimensions[dimension], key), "orphans")
        side = orphans_.select(F.col(column).alias(bad))
        marked = marked.join(side, F.col(column) == F.col(bad), "left")
        flags.append(F.when(F.col(bad).isNotNull(), F.lit(f"{column} not in {dimension}")))
    told = marked.withColumn("reason", F.array_join(F.array_compact(F.array(*flags)), "; "))
    good = told.where(F.col("reason") == "").select(*fact.columns)
    return good, told.where(F.col("reason") != "").select(*fact.columns, "reason")
