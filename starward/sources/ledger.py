"""Counts that a run takes of itself: rows at each step, from the same pass that does the work."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.sources.tables import append_rows, read_table_or_empty

COUNTS = T.StructType(
    [
        T.StructField("run_at", T.TimestampNTZType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


@dataclass
class LossLedger:
    """The rows at each step of a chain; what one step has less than the one before was lost by it.

    The counts are read once the frame has been written; no step is run for them.
    """

    steps: list[tuple[str, Observation]] = field(default_factory=list)

    def watch(self, rows: DataFrame, name: str) -> DataFrame:
        seen = Observation()
        self.steps.append((name, seen))
        return rows.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> dict[str, int]:
        return {name: seen.get["n"] for name, seen in self.steps}

    def losses(self) -> dict[str, int]:
        """Rows that each step after the first dropped."""
        found = list(self.counts().items())
        return {name: before - n for (_, before), (name, n) in zip(found, found[1:], strict=False)}


def watched(ledger: LossLedger | None, rows: DataFrame, name: str) -> DataFrame:
    return rows if ledger is None else ledger.watch(rows, name)


def append_counts(spark: SparkSession, path: str, counts: Iterable[tuple[str, str, int]], at: datetime) -> None:
    """Add ``(table, part, rows)`` of one run."""
    rows = spark.createDataFrame([(at, *c) for c in counts], COUNTS)
    append_rows(rows.coalesce(1), path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_table_or_empty(spark, path, COUNTS)


def balances(counts: DataFrame) -> DataFrame:
    """``table_name, rows_before, rows_added, rows_gone, rows_after, balanced`` of each table and run."""
    of = {p: F.sum(F.when(F.col("part") == p, F.col("n_rows")).otherwise(0)).alias(f"rows_{p}") for p in ("before", "added", "gone", "after")}
    summed = counts.groupBy("run_at", "table_name").agg(*of.values())
    return summed.withColumn("balanced", F.col("rows_before") + F.col("rows_added") - F.col("rows_gone") == F.col("rows_after"))
