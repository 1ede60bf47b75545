"""Operational tables: read, staged copy, append, full refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starward.operators.keys import assign_keys
from starward.sources.scratch import path_exists
from starward.sources.snapshots import SnapshotTable


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table in place: a path (anything with a slash) or a name of the catalog."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table that may not have been written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a database table; with a partition column the copy runs in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_table(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def stage_table(spark: SparkSession, source: DataFrame | str, path: str) -> DataFrame:
    """Full copy of a source table, replacing the copy of the last run.

    The source lives elsewhere, so overwriting in place is safe: nothing reads the old copy here.
    """
    rows = read_table(spark, source) if isinstance(source, str) else source
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add the rows of a query to a table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def full_refresh(
    df: DataFrame, target: SnapshotTable, key: str, order_by: Sequence[str], unique: bool = False
) -> DataFrame:
    """Replace all rows; keys start again at 1."""
    keyed = assign_keys(df, key, order_by=order_by, start=0, unique=unique)
    return target.commit(keyed, key=key, restart=True)
