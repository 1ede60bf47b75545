"""Row counts before and after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, n_rows)`` as one row."""
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def reconcile(before: DataFrame, after: DataFrame, added: DataFrame, name: str) -> DataFrame:
    """One row: the three counts and whether before + added = after."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
        for part, df in (("before", before), ("after", after), ("added", added))
    ]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2])
    of = {
        p: F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"rows_{p}")
        for p in ("before", "added", "after")
    }
    return counts.agg(*of.values()).select(
        F.lit(name).alias("table_name"),
        "rows_before",
        "rows_added",
        "rows_after",
        (F.col("rows_before") + F.col("rows_added") == F.col("rows_after")).alias("balanced"),
    )
