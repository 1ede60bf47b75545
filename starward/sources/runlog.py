"""The run log: an append-only table and the view people read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starward.functions.clock import long_date, short_time
from starward.schemas import WAREHOUSE
from starward.sources.tables import append_rows, read_table_or_empty


def next_event(log: DataFrame, action: str, message: str, at: datetime) -> DataFrame:
    """The one row to append: the next number, the time, and the texts whole."""
    return log.agg((F.coalesce(F.max("ETLLogID"), F.lit(0)) + 1).alias("ETLLogID")).select(
        F.col("ETLLogID").cast("bigint"),
        F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("ETLDateAndTime"),
        F.lit(action).alias("ETLAction"),
        F.lit(message).alias("ETLLogMessage"),
    )


def log_event(log: DataFrame, action: str, message: str, at: datetime) -> DataFrame:
    """The log with one more row."""
    return log.unionByName(next_event(log, action, message, at))


def append_event(spark: SparkSession, path: str, action: str, message: str, at: datetime) -> None:
    append_events(spark, path, [(action, message)], at)


def append_events(spark: SparkSession, path: str, events: Sequence[tuple[str, str]], at: datetime) -> None:
    """Append several events, numbered in their order: one look at the log for the next number and one file for all."""
    log = read_table_or_empty(spark, path, WAREHOUSE["etl_log"])
    top = log.agg(F.max("ETLLogID")).first()[0] or 0
    rows = [(top + 1 + i, at, action, message) for i, (action, message) in enumerate(events)]
    append_rows(spark.createDataFrame(rows, WAREHOUSE["etl_log"]).coalesce(1), path)


def log_view(log: DataFrame) -> DataFrame:
    return log.select(
        "ETLLogID",
        long_date(F.col("ETLDateAndTime")).alias("ETLDate"),
        short_time(F.col("ETLDateAndTime")).alias("ETLTime"),
        "ETLAction",
        "ETLLogMessage",
    )
